"""Token counts without token ids: pieces are counted once per distinct pre-token.

Steps
-----
1. Every text is normalised and split as the tokenizer does it; (pre-token, frequency) is summed
   over the corpus, and each distinct pre-token is run through the merges once. The result is a
   written table (pre-token, frequency, pieces).
2. Each document becomes its pre-token frequencies. The join to the table is divided by frequency:
   the ``hot`` most frequent pre-tokens (a fixed number of rows, so a bounded broadcast) are joined
   inside the scan, all others by a shuffle of (document, pre-token, frequency). No key of the
   shuffled join is frequent, so it has no skew.
3. Sums per document.

Only vocabularies with a ``Split`` pre-tokenizer that keeps the matches are handled here.
Defined results: null and empty texts have 0 bytes and 0 tokens; null or repeated ids are counted
row by row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._frames import map_arrow, written

HOT = 100_000
LIMIT = 2048
HELD = 200_000


class Splitter:
    """Normaliser and pre-tokenizer of a lower-casing ``.json`` vocabulary, and counts of pieces."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        steps = [x["type"] for x in (told["normalizer"] or {}).get("normalizers", [])]
        split = (told["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        if steps != ["NFC", "Replace", "Lowercase"] or (split.get("type"), split.get("behavior"), split.get("invert")) != ("Split", "Removed", True):
            raise ValueError(f"{path}: only lower-casing NFC vocabularies that keep a split's matches are handled")
        pattern = told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # \s of the library is the White_Space property; spelled out, as regex's own \s may differ
        self.find = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}")).findall
        special = sorted((x["content"] for x in told["added_tokens"]), key=len, reverse=True)
        self.special = special
        self.cut = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    @staticmethod
    def normal(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # letter by letter: no final sigma
        return text.lower()

    def split(self, text: str) -> tuple[list[str], int]:
        """The text's pre-tokens and its number of special strings."""
        if self.cut is not None and "<" in text and any(x in text for x in self.special):
            parts = self.cut.split(text)
            return [p for part in parts for p in self.find(self.normal(part))], len(parts) - 1
        return self.find(self.normal(text)), 0

    def pieces(self, pre_tokens: list[str]) -> list[int]:
        return [len(x) for x in self.bare.encode_batch(pre_tokens, add_special_tokens=False)]


_splitters: dict[str, Splitter] = {}


def splitter(path: str) -> Splitter:
    """One for each path and process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _splitters:
        _splitters[path] = Splitter(path)
    return _splitters[path]


def pre_token_table(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(pre_token, n, pieces): frequency in the corpus, and tokens it is made of, once for each distinct pre-token."""

    def make_count():
        tool, held = splitter(path), Counter()

        def flush():
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["pre_token", "n"])
                held.clear()

        def step(batch: pa.RecordBatch):
            for value in batch.column(0):
                value = value.as_py()
                if value:
                    held.update(tool.split(value)[0])
                    if len(held) > HELD:
                        yield from flush()

        step.finish = flush
        return step

    def make_pieces():
        tool = splitter(path)

        def step(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(tool.pieces(part.column(0).to_pylist()), pa.int64())], ["pre_token", "n", "pieces"])

        return step

    found = map_arrow(docs, [text], "pre_token string, n bigint", make_count).groupBy("pre_token").agg(F.sum("n").alias("n"))
    return written(map_arrow(found, ["pre_token", "n"], "pre_token string, n bigint, pieces bigint", make_pieces), "pre-tokens")


def token_counts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", limit: int = LIMIT, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit."""
    table = pre_token_table(docs, path, text)
    frequent = {r.pre_token: r.pieces for r in table.orderBy(F.desc("n"), "pre_token").limit(hot).select("pre_token", "pieces").toLocalIterator()}

    def make():
        tool = splitter(path)
        known = frequent.get

        def step(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sizes, sums, names, counts, ends = [], [], [], [], [0]
                for value in part.column(2):
                    value = value.as_py() or ""
                    found, total = tool.split(value)
                    for name, n in Counter(found).items():
                        pieces = known(name)
                        if pieces is None:
                            names.append(name)
                            counts.append(n)
                        else:
                            total += n * pieces
                    sizes.append(len(value.encode()))
                    sums.append(total)
                    ends.append(len(names))
                rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["pre_token", "n"]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), rare], ["row", id, "n_bytes", "known", "rare"])

        return step

    kind = dict(docs.dtypes)[id]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), id, text)
    rows = written(map_arrow(rows, ["row", id, text], f"row bigint, `{id}` {kind}, n_bytes bigint, known bigint, rare array<struct<pre_token:string,n:bigint>>", make), "document-pre-tokens")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.pre_token", F.col("r.n").alias("times"))
    sums = rare.join(table.select("pre_token", "pieces"), "pre_token").groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("more"))
    total = F.col("known") + F.coalesce("more", F.lit(0))
    return rows.select("row", id, "n_bytes", "known").join(sums, "row", "left").select(id, "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))
