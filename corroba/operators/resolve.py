"""Entity resolution: exact and alias forms, then similar names, in rounds that keep the order of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import names, similarity


def forms(name: Column) -> Column:
    """Lookup forms in order of preference: as written, normalised, first and last word; lower case."""
    return F.array(F.lower(names.strip(name)), F.lower(names.normalize_name(name)), F.lower(names.short_name(name)))


def name_index(registry: DataFrame) -> DataFrame:
    """(form, canonical_id, canonical_form, seq): all forms of names and aliases; per form the last writer.

    ``registry`` has (canonical_id, canonical_name, aliases, seq).
    """
    every = F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = registry.select("canonical_id", F.lower("canonical_name").alias("canonical_form"), "seq", F.posexplode(every).alias("pos", "name"))
    rows = rows.select("canonical_id", "canonical_form", "seq", "pos", F.explode(forms(F.col("name"))).alias("form")).where("form <> ''")
    last = rows.groupBy("form").agg(F.max_by(F.struct("canonical_id", "canonical_form", "seq"), F.struct("seq", "pos")).alias("e"))
    return last.select("form", "e.canonical_id", "e.canonical_form", "e.seq")


def exact_alias_match(probes: DataFrame, index: DataFrame) -> DataFrame:
    """``probes`` (key, name) matched by their first form that is known: exact 1.0 or alias 0.95.

    One join for the three forms; the best place wins.
    """
    told = probes.select("key", F.posexplode(forms(F.col("name"))).alias("place", "form"))
    hit = told.join(index, "form").groupBy("key").agg(F.min_by(F.struct("canonical_id", (F.col("form") == F.col("canonical_form")).alias("same")), "place").alias("m"))
    return hit.select("key", F.col("m.canonical_id").alias("canonical_id"), F.when(F.col("m.same"), "exact").otherwise("alias").alias("match_method"), F.when(F.col("m.same"), 1.0).otherwise(0.95).alias("match_confidence"))


def _segments(s: Column, cutoff: float) -> Column:
    """Parts of which one at least is unchanged in every text that reaches the cutoff.

    A text of length n admits partners up to n * (2 / t - 1) and so k = (1 - t) * (n + that) edits; k + 1 parts.
    """
    t = cutoff / 100.0
    k = F.floor((1 - t) * F.length(s) * (2 / t) + 1e-9).cast("int")
    bound = lambda i: F.floor(i * F.length(s) / (k + 1)).cast("int")
    return F.array_distinct(F.transform(F.sequence(F.lit(0), k), lambda i: F.substr(s, bound(i) + 1, bound(i + 1) - bound(i))))


def _substrings(s: Column, longest: int) -> Column:
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1))), lambda i: F.substr(s, i, n)))))


def similar_candidates(left: DataFrame, right: DataFrame, cutoff: float = config.FUZZY_CUTOFF) -> DataFrame:
    """(key, id, a, b): pairs of sorted names that may reach the cutoff; none that reaches it is missing.

    ``left`` has (key, a), ``right`` has (id, b). Pairs meet on an unchanged part, then pass the length and
    edit bounds; all pairs are never formed. Equal texts of a side meet once, and their rows are joined to what they found.
    """
    t = cutoff / 100.0
    longest = int(1 / ((1 - t) * 2 / t)) + 1
    parts = right.where("b <> ''").select("b").distinct().select("b", F.explode(_segments(F.col("b"), cutoff)).alias("part"))
    probes = left.where("a <> ''").select("a").distinct().select("a", F.explode(_substrings(F.col("a"), longest)).alias("part"))
    met = probes.join(parts, "part").where(similarity.may_reach(F.col("a"), F.col("b"), cutoff)).select("a", "b").distinct()
    return left.select("key", "a").distinct().join(met, "a").join(right.select("id", "b").distinct(), "b").select("key", "id", "a", "b")


def fuzzy_match(probes: DataFrame, registry_names: DataFrame, cutoff: float = config.FUZZY_CUTOFF) -> DataFrame:
    """Best similar name of each probe (key, name); names of up to ten characters need a higher ratio.

    ``registry_names`` has (canonical_id, name, pos), ``pos`` of any ordered type; ties go to the smaller one. Numbered references never match.
    """
    left = probes.where(~names.is_numbered_reference(F.col("name"))).select("key", names.normalize_name(F.col("name")).alias("n")).select("key", F.length("n").alias("size"), similarity.token_sort(F.col("n")).alias("a"))
    right = registry_names.select(F.struct("pos", "canonical_id").alias("id"), similarity.token_sort(names.normalize_name(F.col("name"))).alias("b"))
    # equal names have equal ratios: one of each meets, the registry's first, and the best is carried back to every probe
    right = right.groupBy("b").agg(F.min("id").alias("id"))
    scored = similar_candidates(left.select(F.col("a").alias("key"), "a").distinct(), right, cutoff).withColumn("score", similarity.sorted_ratio("a", "b")).where(F.col("score") >= cutoff)
    best = scored.groupBy("a").agg(F.min_by(F.struct("score", "id"), F.struct(-F.col("score"), F.col("id.pos"))).alias("m")).join(left, "a")
    good = (F.col("size") > config.SHORT_NAME) | (F.col("m.score") >= config.SHORT_CUTOFF)
    return best.where(good).select("key", F.col("m.id.canonical_id").alias("canonical_id"), F.lit("fuzzy").alias("match_method"), (F.col("m.score") / 100).alias("match_confidence"))


def resolve(probes: DataFrame, registry: DataFrame, cutoff: float = config.FUZZY_CUTOFF) -> DataFrame:
    """``probes`` (key, name) against a fixed registry: canonical_id or null, method and confidence."""
    blank = names.strip(F.coalesce("name", F.lit(""))) == ""
    gate = probes.select("key", "name", F.when(blank, "no_match").when(names.is_noise_name(F.col("name")), "noise").alias("gate"))
    open_ = gate.where("gate is null")
    direct = exact_alias_match(open_, name_index(registry))
    rest = open_.join(direct, "key", "left_anti")
    every = registry.select("canonical_id", F.posexplode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("k", "name"), "seq").select("canonical_id", "name", F.struct("seq", "k").alias("order"))
    found = direct.unionByName(fuzzy_match(rest, every.withColumnRenamed("order", "pos"), cutoff))
    return gate.join(found, "key", "left").select("key", "name", "canonical_id", F.coalesce("match_method", "gate", F.lit("no_match")).alias("match_method"), F.coalesce("match_confidence", F.lit(0.0)).alias("match_confidence"))


def resolve_in_order(probes: DataFrame, registry: DataFrame, materialise, prefix: str = "PER", cutoff: float = config.FUZZY_CUTOFF) -> tuple[DataFrame, DataFrame]:
    """Sequential semantics in rounds: a name that matches nothing founds an entity that later names can match.

    ``probes`` has (key, name, variants), in the order of ``key``; ``registry`` entries have ``seq`` below every key.
    Every name and variant is an entry at its place in the order. Which earlier entries a name could match, by an equal
    form or a ratio that reaches the cutoff, does not depend on any outcome, so it is computed once; a name waits for the
    probes among them. A round then only looks up which entities those entries belong to by now. Returns the
    resolutions and those that founded entities. ``materialise`` writes a frame and returns it read again.
    """
    none = F.array().cast("array<string>")
    probes = materialise(probes.select(F.col("key").cast("long").alias("key"), "name", F.coalesce("variants", none).alias("variants")))
    registry = materialise(registry.select(F.col("seq").cast("long").alias("seq"), "canonical_id", "canonical_name", F.coalesce("aliases", none).alias("aliases")))
    entries = registry.select("seq", F.posexplode(F.concat(F.array("canonical_name"), "aliases")).alias("pos", "entry")).unionByName(probes.select(F.col("key").alias("seq"), F.posexplode(F.concat(F.array("name"), "variants")).alias("pos", "entry")))
    entries = materialise(entries.where("entry is not null").select("seq", "pos", forms(F.col("entry")).alias("forms"), similarity.token_sort(names.normalize_name(F.col("entry"))).alias("sorted")))
    blank = names.strip(F.coalesce("name", F.lit(""))) == ""
    gate = materialise(probes.select("key", "name", F.when(blank, "no_match").when(names.is_noise_name(F.col("name")), "noise").alias("gate"), names.is_numbered_reference(F.col("name")).alias("numbered"), F.length(names.normalize_name(F.col("name"))).alias("size")))
    told = gate.where("gate is null").select("key").join(entries.where("pos = 0").withColumnRenamed("seq", "key"), "key")

    own = told.select("key", F.posexplode("forms").alias("place", "form"))
    equal = materialise(own.join(entries.select("seq", "pos", F.explode("forms").alias("form")), "form").where("form <> '' and seq < key").select("key", "place", "form", "seq", "pos").distinct())
    left = told.join(gate.where("not numbered").select("key"), "key", "left_semi").select("key", F.col("sorted").alias("a"))
    near = similar_candidates(left, entries.select(F.struct("seq", "pos").alias("id"), F.col("sorted").alias("b")), cutoff).where("id.seq < key")
    near = materialise(near.select("key", "id.seq", "id.pos", similarity.sorted_ratio("a", "b").alias("score")).where(F.col("score") >= cutoff))
    waits = equal.select("key", F.col("seq").alias("on")).unionByName(near.select("key", F.col("seq").alias("on"))).distinct()
    waits = materialise(waits.join(probes.select(F.col("key").alias("on")), "on", "left_semi"))

    done: DataFrame | None = None
    while True:  # the first open name never waits, so each round resolves some
        open_ = gate if done is None else gate.join(done.select("key"), "key", "left_anti")
        ready = materialise(open_.join(waits.join(open_.select(F.col("key").alias("on")), "on", "left_semi"), "key", "left_anti"))
        if not ready.head(1):
            break
        got = _resolve_round(ready, equal, near, registry, done, prefix)
        done = materialise(got if done is None else done.unionByName(got))
    result = done if done is not None else _resolve_round(gate.where("false"), equal, near, registry, None, prefix)
    return result, result.where("match_method = 'new_entity'")


def _resolve_round(ready: DataFrame, equal: DataFrame, near: DataFrame, registry: DataFrame, done: DataFrame | None, prefix: str) -> DataFrame:
    """Resolutions of names that no longer wait, from the entities that earlier entries belong to."""
    owners = registry.select("seq", "canonical_id")
    mains = registry.groupBy("canonical_id").agg(F.min_by(F.lower("canonical_name"), "seq").alias("main"))
    if done is not None:
        owners = owners.unionByName(done.where("canonical_id is not null").select(F.col("key").alias("seq"), "canonical_id"))
        mains = mains.unionByName(done.where("match_method = 'new_entity'").select("canonical_id", F.lower("name").alias("main")))
    keys = ready.select("key")
    hit = equal.join(keys, "key", "left_semi").join(owners, "seq").groupBy("key").agg(F.min_by(F.struct("canonical_id", "form"), F.struct(F.col("place"), -F.col("seq"), -F.col("pos"))).alias("m"))
    hit = hit.select("key", F.col("m.canonical_id").alias("canonical_id"), F.col("m.form").alias("form")).join(mains, "canonical_id", "left").select("key", "canonical_id", (F.col("form") == F.col("main")).alias("same"))
    best = near.join(keys, "key", "left_semi").join(owners, "seq").groupBy("key").agg(F.max_by(F.struct("score", F.col("canonical_id").alias("id")), F.struct(F.col("score"), -F.col("seq"), -F.col("pos"))).alias("b"))
    out = ready.join(hit, "key", "left").join(best, "key", "left")
    similar = F.col("b").isNotNull() & ((F.col("size") > config.SHORT_NAME) | (F.col("b.score") >= config.SHORT_CUTOFF))
    method = F.when(F.col("gate").isNotNull(), F.col("gate")).when(F.col("same"), "exact").when(F.col("canonical_id").isNotNull(), "alias").when(similar, "fuzzy").otherwise("new_entity")
    rows = out.select("key", "name", method.alias("match_method"), "canonical_id", "b")
    cid = F.when(F.col("match_method") == "new_entity", entity_id(F.col("key"), prefix)).when(F.col("match_method") == "fuzzy", F.col("b.id")).when(F.col("match_method").isin("exact", "alias"), F.col("canonical_id"))
    sure = F.when(F.col("match_method").isin("exact", "new_entity"), 1.0).when(F.col("match_method") == "alias", 0.95).when(F.col("match_method") == "fuzzy", F.col("b.score") / 100).otherwise(0.0)
    return rows.select("key", "name", cid.alias("canonical_id"), "match_method", sure.alias("match_confidence"))


def merge_aliases(entities: DataFrame, added: DataFrame) -> DataFrame:
    """``entities`` with (canonical_id, alias, pos) appended, without repeats of name or aliases in any case."""
    more = added.groupBy("canonical_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "alias"))), lambda x: x["alias"]).alias("more"))
    none = F.array().cast("array<string>")
    every = F.concat(F.coalesce("aliases", none), F.coalesce("more", none))
    fresh = F.filter(every, lambda a, i: a.isNotNull() & (a != "") & (F.lower(a) != F.lower("canonical_name")) & ~F.array_contains(F.transform(F.slice(every, F.lit(1), i), F.lower), F.lower(a)))
    return entities.join(more, "canonical_id", "left").withColumn("aliases", fresh).select(*entities.columns)


def numbered(rows: DataFrame, order: list[str], taken: int, column: str, materialise=None) -> DataFrame:
    """``rows`` with ``column`` counting from ``taken`` + 1 in a total order.

    A running count over range partitions, so no task holds all rows. Rows and partition sizes must come from one
    division into ranges: ``materialise`` writes it and reads it again.
    """
    from pyspark.sql import Window

    spread = rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    within = spread.withColumn("__n", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    within = materialise(within) if materialise is not None else within
    sizes = within.groupBy("__part").agg(F.max("__n").alias("__size"))  # a row per partition
    before = sizes.select("__part", (F.sum("__size").over(Window.orderBy("__part")) - F.col("__size")).alias("__before"))
    return within.join(F.broadcast(before), "__part").withColumn(column, F.col("__n") + F.col("__before") + taken).drop("__part", "__n", "__before")


def entity_id(number: Column, prefix: str) -> Column:
    """PREFIX-00042; numbers beyond five digits stay whole."""
    text = number.cast("string")
    return F.concat(F.lit(f"{prefix}-"), F.when(number < 100_000, F.lpad(text, 5, "0")).otherwise(text))


def next_ids(rows: DataFrame, order: list[str], taken: int, prefix: str) -> DataFrame:
    """``rows`` with ``canonical_id`` numbered after ``taken`` in a total order."""
    return numbered(rows, order, taken, "__number").withColumn("canonical_id", entity_id(F.col("__number"), prefix)).drop("__number")
