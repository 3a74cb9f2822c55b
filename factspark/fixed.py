"""Fixed values of the question rules: word lists, property and class ids, closed vocabularies."""

# Phrases that tie a text to a time, and month names (matched as words, in either case).
TEMPORAL_PHRASES = (
    "this year", "last year", "next year", "recent", "recently", "current", "currently", "latest", "newest", "former", "previous", "as of",
)
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
# Further phrases that the design forbids; off unless asked for.
EXTRA_TEMPORAL_PHRASES = ("in the year", "released in", "published in", "opened in", "founded in", "established in")

# Properties whose values change with time.
MUTABLE_ROLE_PIDS = ("P26", "P39", "P54", "P102", "P108")
RISK_PIDS = (*MUTABLE_ROLE_PIDS, "P106", "P136", "P161", "P162", "P166", "P400", "P1082", "P1128")
# The same properties and one more, by the reason the design gives for each.
RELATIONSHIP_PIDS = ("P26", "P451")
AFFILIATION_PIDS = ("P39", "P54", "P102", "P108")
STATISTIC_PIDS = ("P1082", "P1128")

# Wordings that ask for something that changes.
RELATIONSHIP_HINTS = (
    "wife", "husband", "spouse", "partner", "married to", "employer", "play for", "plays for", "current ceo", "current president", "current mayor", "current minister",
)
STATISTIC_HINTS = (
    "how many", "total", "career", "citations", "followers", "net worth", "box office", "revenue", "sales", "downloads", "wins", "losses", "goals", "appearances", "points",
)

# Wordings of questions that aren't short and plain, and the longest plain one.
NOT_SIMPLE = ("and why", "explain", "compare", "list all")
SIMPLE_LENGTH = 200

# Type labels that may replace a template's kind of subject, and labels that say too little to do so.
KIND_OVERRIDES = {
    "artwork": ("mural", "painting", "sculpture", "work of art", "installation art"),
    "film": ("anime film", "feature film", "documentary film", "short film"),
    "album": ("studio album", "live album", "extended play", "ep"),
    "building": ("arena", "tower", "hall", "centre", "center"),
    "scholarly article": ("academic work", "working paper", "scholarly article"),
    "video game": ("fan disc", "visual novel", "role-playing video game"),
}
GENERIC_KINDS = ("entity", "creative work", "work", "object", "item")

# Classes of institutions that grant a first degree; sports seasons; humans; universities; films.
DEGREE_CLASSES = ("Q3918", "Q615150", "Q62078547", "Q2085381", "Q23002039")
SEASON_CLASS, HUMAN_CLASS, UNIVERSITY_CLASS, FILM_CLASS = "Q27020041", "Q5", "Q3918", "Q11424"

# Reasoning styles by the names they come under, and those that take more than one hop.
STYLES = {
    "single_fact": "single_fact",
    "fact_join": "multi_hop_join",
    "ordinal_fact": "multi_hop_ordinal",
    "multi_hop_join": "multi_hop_join",
    "multi_hop_ordinal": "multi_hop_ordinal",
    "multi_hop_aggregate": "multi_hop_aggregate",
}
MULTI_HOP_STYLES = ("multi_hop_join", "multi_hop_ordinal", "multi_hop_aggregate")

# Every reason a candidate or a rewrite can be turned down for.
REASONS = (
    "subject_label_contains_temporal_expression", "subject_label_contains_year", "answer_not_time_invariant", "future_dated_or_unsettled_fact",
    "mutable_relationship_or_status", "mutable_affiliation_or_office", "cumulative_statistic", "answer_not_unique", "no_english_label", "no_answer_label",
    "same_label_competitor_requires_temporal_disambiguation", "no_non_temporal_signature", "descriptor_leaks_answer", "canonical_question_failed_validation",
    "rewrite_contains_year", "rewrite_contains_temporal_expression", "rewrite_lost_required_anchor", "rewrite_leaks_answer", "duplicate_question", "quota_exceeded",
    "reasoning_path_not_connected", "shortcut_answerable_without_all_hops", "bridge_entity_leaks_answer", "provenance_incomplete", "ordinal_derivation_not_safe",
)

# The prefix of entity addresses, and of the ids of accepted records.
ENTITY_PREFIX = "http://www.wikidata.org/entity/"
ID_PREFIX = "wikidata_verified_pilot"
