"""Vocabularies, weights and limits. All are defaults of operator parameters and can be replaced."""

from __future__ import annotations

# ---- fixed values: lists that results depend on -------------------------------------------------

NAME_SUFFIXES = (
    ", Esq.", " Esq.", ", Jr.", " Jr.", ", Sr.", " Sr.", ", III", " III", ", II", " II",
    ", IV", " IV", ", M.D.", " M.D.", ", Ph.D.", " Ph.D.", ", J.D.", " J.D.",
)

TITLES = (
    "president ", "professor ", "prof. ", "senator ", "rep. ", "judge ", "justice ", "attorney ", "agent ",
    "dr. ", "mr. ", "mrs. ", "ms. ", "miss ", "sir ", "lord ", "lady ", "prince ", "princess ", "king ", "queen ",
    "sheikh ", "imam ", "general ", "colonel ", "captain ", "detective ", "governor ", "mayor ", "ambassador ",
)

NOISE_SUBSTRINGS = (
    "unknown person", "unknown company", "unknown organization", "unidentified", "unnamed", "redacted", "sealed",
    "various ", "multiple ", "participants", "attendees", "author", "narrator", "reporter", "plaintiff", "defendant",
    "witness", "victim", "employee", "the government", "the court", "prosecution", "defense counsel",
    "security clearance", "technology industry",
)

NOISE_PATTERNS = (
    r"^unknown(\s+(person|individual|man|woman|company|organization))?$", r"^(unidentified|unnamed)\b", r"^(various|multiple)\b",
    r"^(employee|victim|witness)\s*[#]?\d+\b", r"^(john|jane)\s+doe\s*[#]?\d+\b", r"^\(b\)\(\d+\)",
)

NUMBERED_PATTERN = r"(?:Jane|John)\s+Doe\s*[#]?\d|Employee[- ]?\d|Detective\s*\d|Victim\s*[#]?\d"

GENERIC_WORDS = (
    "president", "attorney", "judge", "senator", "detective", "agent", "officer", "prosecutor", "prosecutors", "counsel",
    "public", "communication", "journalist", "journalists", "applicant", "appellant", "respondent", "government", "state",
    "country", "federal prosecutors", "federal agents", "federal government", "law enforcement", "defense counsel", "legal counsel",
)

FIRST_NAMES = (
    "mary", "david", "sarah", "john", "james", "michael", "robert", "tony", "leon", "eva", "rebecca", "bruce", "roger",
    "ralph", "warren", "mark", "steve", "chris", "peter", "paul", "george", "jane", "tom", "joe",
)

EXPANDED_PATTERNS = (r"^\w+\s+\?$", r"^\w{1,2}$", r"^[A-Z]\.[A-Z]\.$")

GRAPH_NOISE = ("unknown person", "unknown company", "author", "narrator", "unidentified", "unnamed", "various ", "multiple ")

RANKING_NOISE = (
    "unknown person", "unknown company", "author", "narrator", "unidentified", "unnamed", "various ", "multiple ",
    "plaintiff and ", "participants", "security clearance", "technology industry", "whistleblower", "embryonic stem",
    "unknown organization", "unknown individual", "unknown entity", "redacted", "sealed", "attendee", "attendees",
    "reporter", "plaintiff", "defendant", "witness", "victim", "employee-", "employee ", "victim ", "witness ",
    "john doe", "jane doe", "the government", "the court", "prosecution", "defense counsel",
)

RANKING_PATTERNS = (r"^(employee|victim|witness)\s*[#]?\d+\b", r"^(john|jane)\s+doe\s*[#]?\d+\b", r"^\(b\)\(\d+\)")

REDACTED_WORDS = ("unknown", "unidentified", "n/a", "redacted", "sealed")

ACTION_TYPES = (
    ("traveled with", "traveled_with"), ("flew with", "traveled_with"), ("associated with", "associated_with"),
    ("met with", "associated_with"), ("employed", "employed_by"), ("hired", "employed_by"), ("paid", "financial"),
    ("funded", "financial"), ("donated to", "financial"), ("communicated with", "communicated_with"),
    ("called", "communicated_with"), ("emailed", "communicated_with"), ("represented", "represented_by"),
)
DEFAULT_ACTION_TYPE = "associated_with"

ID_PREFIXES = {"person": "PER", "organization": "ORG", "location": "LOC", "document": "DOC", "aircraft": "AIR", "property": "PROP", "shell_company": "ORG"}

EVIDENCE_WEIGHTS = {"curated": 1.5, "rdf": 1.0, "corpus_cooccurrence": 0.9, "cooccurrence": 0.5, "other": 0.6}

# ---- configuration ------------------------------------------------------------------------------

#: Single words that are real names although they are one word.
PROTECTED_WORDS: tuple[str, ...] = ()
#: Evidence class of each source system, where a provenance row has none of its own.
SYSTEM_CLASSES = {"registry": "curated", "triples": "rdf", "documents": "cooccurrence", "corpus": "corpus_cooccurrence"}
#: Month (yyyy-MM) -> label.
KEY_EVENTS: dict[str, str] = {}

EDGE_CONFIDENCE = {"registry": 1.0, "documents": 0.5, "triples": 0.7, "corpus_known": 0.6, "corpus_new": 0.5}
DOCUMENT_CAP, SAMPLE, TRIPLE_CAP, TOP_ACTIONS = 200, 20, 5, 20
FUZZY_CUTOFF, SHORT_NAME, SHORT_CUTOFF = 90.0, 10, 95.0
NOISE_FLAG_ABOVE = 50
