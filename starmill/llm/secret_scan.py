"""Secrets in texts, and who owns them.

Spans. Three kinds are found by pattern: a password-like name with a value (assign), access
key ids (access), and long runs of hex digits (hex). Positions come from the lengths of the
pieces between matches, so everything is an expression on one row.

Ownership. The hash of every value is counted over the corpus by distinct repositories and
owners. A value that more than ``MAX_OWNERS`` owners carry is a copied example. One of a
single owner or two that looks live (long enough, letters and digits, many different
characters, no word for an example) is a credential; where it stands bare in some text,
outside any span found by pattern, that place is added as a span of kind ``live``. Inside a
run of value characters, as in NAME=value, a URL or a file name, it may begin and end at
any character that is not a letter or digit. Parts are what other characters separate. A run
offers, for every number of parts that a known value has, all its stretches of that many
parts, each under the hash of the whole stretch: values that begin alike, as those of one
service do, do not meet each other's runs.

NULL texts are empty. A NULL owner or repository counts as one of its own. Rows that repeat
doc_id and text count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import row_id, shown_id, small_or_shuffled, text_key, written

# The patterns of the three kinds, the value's group, and its least length.
KINDS = (
    (
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
BARE = r"(?<![A-Za-z0-9+/_.=-])(?=[A-Za-z+/_.=-]*+[0-9])[A-Za-z0-9+/_.=-]{16,}+"
PART = "[A-Za-z0-9]+"
EXAMPLE = r"(?i)example|sample|dummy|placeholder|change.?me|your|xxxx|test|1234567|abcdef"
MAX_OWNERS = 2
# Known values that may be broadcast, about a hundred bytes each, and bytes of spans of documents.
BROADCAST_VALUES, BROADCAST_BYTES = 200_000, 32 << 20
LEAST_LIVE, LEAST_CHARACTERS = 16, 8

_SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _matches(text: str, pattern: str, group: int, least: int, kind: int) -> Column:
    """Spans of the leftmost non-overlapping matches whose value is long enough."""
    quoted = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    fold = f"""
        aggregate(
          arrays_zip(split({text}, {quoted}, -1), regexp_extract_all({text}, {quoted}, 0),
                     regexp_extract_all({text}, {quoted}, {group})),
          struct(0 AS at, cast(array() AS array<{_SPAN}>) AS found),
          (state, m) -> struct(
            state.at + length(m.`0`) + coalesce(length(m.`1`), 0) AS at,
            if(length(m.`2`) >= {least},
               concat(state.found, array(named_struct(
                 'start', state.at + length(m.`0`), 'kind', {kind},
                 'end', state.at + length(m.`0`) + length(m.`1`), 'value', m.`2`))),
               state.found) AS found),
          state -> state.found)
    """
    found = F.expr(fold)
    return F.when(F.col(text).rlike(pattern), found).otherwise(F.expr(f"cast(array() AS array<{_SPAN}>)"))


def scan(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """(_id, _th, _owner, _repository, _base, _bare) without the texts."""
    base = docs.select(
        row_id().alias("_id"),
        text_key().alias("_th"),
        owner.cast("string").alias("_owner"),
        repository.cast("string").alias("_repository"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    parts = [_matches("_text", p, g, least, k) for k, (_, p, g, least) in enumerate(KINDS)]
    return base.select(
        "_id", "_th", "_owner", "_repository",
        F.sort_array(F.concat(*parts)).alias("_base"),
        _matches("_text", BARE, 0, LEAST_LIVE, len(KINDS)).alias("_bare"),
    )


def _trimmed(value: str) -> Column:
    return F.regexp_replace(value, "[.=]+$", "")


def ownership(scanned: DataFrame) -> DataFrame:
    """Per value hash: n_documents, n_repositories, n_owners, live, and how to find it in a run:
    _parts, _core (hash of the value from its first part to its last), _lead (characters
    before that), _length."""
    value = _trimmed("_s.value")
    rows = scanned.select("_id", "_th", "_owner", "_repository", F.explode("_base").alias("_s"))
    rows = rows.select("_id", "_th", "_owner", "_repository", F.sha2(value, 256).alias("_hash"), (
        (F.length(value) >= LEAST_LIVE)
        & value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & ~value.rlike(EXAMPLE)
        & (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_CHARACTERS)
    ).alias("_live"), F.struct(
        F.size(F.regexp_extract_all(value, F.lit(PART), F.lit(0))).alias("_parts"),
        F.xxhash64(F.regexp_replace(value, "^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "")).alias("_core"),
        F.length(F.regexp_extract(value, "^[^A-Za-z0-9]*", 0)).alias("_lead"),
        F.length(value).alias("_length"),
    ).alias("_place"))
    # Counted level by level: each grouping has a map-side part, so a value in a third of
    # all documents is thousands of partial rows, not one group.
    marks = F.max("_live").alias("_live"), F.max("_place").alias("_place")
    per_doc = rows.groupBy("_hash", "_owner", "_repository", "_id", "_th").agg(*marks)
    per_repository = per_doc.groupBy("_hash", "_owner", "_repository").agg(F.count("*").alias("_n"), *marks)
    per_owner = per_repository.groupBy("_hash", "_owner").agg(
        F.sum("_n").alias("_n"), F.count("*").alias("_r"), *marks
    )
    return per_owner.groupBy("_hash").agg(
        F.sum("_n").alias("n_documents"),
        F.sum("_r").alias("n_repositories"),
        F.count("*").alias("n_owners"),
        *marks,
    ).select("*", "_place.*").drop("_place")


def _extra(scanned: DataFrame, known: DataFrame) -> DataFrame:
    """(_id, _th, _place): known live values in bare runs, outside all spans found by pattern."""
    live = written(known.where("_class = 'live'").select("_hash", "_parts", "_core", "_lead", "_length"))
    # The numbers of parts that occur: one small array.
    sizes = live.agg(F.collect_set("_parts")).scalar()
    live = small_or_shuffled(live.drop("_parts"), BROADCAST_VALUES)
    runs = scanned.select("_id", "_th", "_base", F.explode("_bare").alias("_s"))
    runs = runs.select("*", F.col("_s.value").alias("_run")).withColumn("_sizes", sizes)
    runs = runs.withColumn("_p", _matches("_run", PART, 0, 1, 0))
    stretches = """
        flatten(transform(filter(_sizes, m -> m <= size(_p)), m ->
          transform(sequence(0, size(_p) - m), i -> struct(
            _p[i].start AS start,
            xxhash64(substring(_run, _p[i].start + 1, _p[i + m - 1].end - _p[i].start)) AS core))))
    """
    offered = runs.select("_id", "_th", "_base", "_s", "_run", F.explode(F.expr(stretches)).alias("_o"))
    met = offered.withColumn("_core", F.col("_o.core")).join(live, "_core")
    met = met.withColumn("_at", F.col("_o.start") - F.col("_lead"))
    value, after = F.expr("substring(_run, _at + 1, _length)"), F.expr("substring(_run, _at + _length + 1, 1)")
    whole = (F.col("_at") >= 0) & ~after.rlike(PART) & (F.sha2(value, 256) == F.col("_hash"))
    start = F.col("_s.start") + F.col("_at")
    span = F.struct(
        start.alias("start"), F.lit(len(KINDS)).alias("kind"), (start + F.col("_length")).alias("end"), value.alias("value")
    )
    placed = met.where(whole).select("_id", "_th", "_base", span.alias("_place"))
    outside = ~F.exists(
        "_base", lambda b: (b["start"] < F.col("_place.end")) & (F.col("_place.start") < b["end"])
    )
    return placed.where(outside).select("_id", "_th", "_place").distinct()


def find(docs: DataFrame, owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, _th, _base and _added spans, n_live, n_copied.

    ``owner`` defaults to the source, ``repository`` to source and language.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    scanned = written(scan(docs, owner, repository))
    known = written(ownership(scanned).select(
        "_hash", "_parts", "_core", "_lead", "_length",
        F.when(F.col("n_owners") > MAX_OWNERS, "copied").when(F.col("_live"), "live").alias("_class"),
    ).where("_class is not null"))
    base = scanned.select("_id", "_th", F.explode("_base").alias("_s")).distinct()
    classed = base.withColumn("_hash", F.sha2(_trimmed("_s.value"), 256)).join(known, "_hash")
    place = _extra(scanned, known)
    both = classed.select("_id", "_th", "_class", F.lit(None).cast(_SPAN).alias("_place")).union(
        place.select("_id", "_th", F.lit("live"), "_place")
    )
    per_document = both.groupBy("_id", "_th").agg(
        F.collect_list("_place").alias("_added"),
        F.count(F.when(F.col("_class") == "live", 1)).alias("n_live"),
        F.count(F.when(F.col("_class") == "copied", 1)).alias("n_copied"),
    )
    return scanned.select("_id", "_th", "_base").join(per_document, ["_id", "_th"], "left").select(
        "_id", "_th", "_base",
        F.coalesce("_added", F.expr(f"cast(array() AS array<{_SPAN}>)")).alias("_added"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k[0]) for k in KINDS), F.lit("live"))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def report(docs: DataFrame, owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied."""
    found = find(docs, owner, repository)
    counts = [
        F.expr(f"size(filter(_base, s -> s.kind = {k}))").cast("bigint").alias(f"n_{name}")
        for k, (name, *_) in enumerate(KINDS)
    ]
    return found.select(
        shown_id(), *counts,
        F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"),
        _listed(F.sort_array(F.concat("_base", "_added"))).alias("spans"),
        "n_live", "n_copied",
    )


def masked(docs: DataFrame, owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """``docs`` with every secret replaced by ``<SECRET>``; n_chars follows the new text.

    Overlapping spans become one mark. Values known as copied examples are masked as well,
    since a copied credential may still be someone's.
    """
    places = F.sort_array(F.concat("_base", "_added"))
    # Only where spans begin and end is kept, no values.
    places = F.transform(places, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    found = find(docs, owner, repository).select("_id", "_th", places.alias("_spans"))
    spans = written(found.where(F.size("_spans") > 0).dropDuplicates(["_id", "_th"]))
    size = spans.agg(F.sum(64 + 32 * F.size("_spans"))).first()[0] or 0
    spans = F.broadcast(spans) if size <= BROADCAST_BYTES else spans
    mine = docs.select(F.struct(*docs.columns).alias("_row"), row_id().alias("_id"), text_key().alias("_th"))
    joined = mine.join(spans, ["_id", "_th"], "left")
    cut = """
        aggregate(_spans, struct(0 AS at, cast('' AS string) AS kept),
          (state, s) -> if(s.end <= state.at, state, struct(
            s.end AS at,
            if(s.start < state.at, state.kept,
               concat(state.kept, substring(_row.text, state.at + 1, s.start - state.at), '<SECRET>')) AS kept)),
          state -> concat(state.kept, substring(_row.text, state.at + 1, 2147483647)))
    """
    new = F.when(F.col("_spans").isNull(), F.col("_row.text")).otherwise(F.expr(cut))
    out = []
    for name in docs.columns:
        if name == "text":
            out.append(new.alias("text"))
        elif name == "n_chars":
            kind = docs.schema["n_chars"].dataType
            out.append(F.when(F.col("_spans").isNull(), F.col("_row.n_chars")).otherwise(F.length(new)).cast(kind).alias("n_chars"))
        else:
            out.append(F.col("_row").getField(name).alias(name))
    return joined.select(*out)
