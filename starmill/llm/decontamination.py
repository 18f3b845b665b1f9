"""Benchmark questions in documents, also with other numbers, names and units.

Templates. In benchmark items and documents, numbers become <n>, unit words after a number
<u>, and capitalised words <p>, also at the start of a sentence, apart from a fixed list of
function words; the rest is lower-cased. Windows of five
template tokens are hashed and joined. An item is suspected in a document that holds at
least 80 % of its windows; windows with fewer than two literal tokens do not count.

Slots. Where the placeholders of an item meet a document's tokens along one alignment, every
value of the item must meet one value; units count as one in singular, plural and short form.
Two names of an item must not meet one name, but new numbers and units may coincide.
Alignments that break this are chance meetings of a template and are dropped; the rest must
still hold 80 %. An item is met verbatim if no value differs in its raw form.

NULL texts are empty. Items without five tokens, or without a window that counts, are never
found. Items that repeat an id with another text are told apart by their text. Rows that
repeat doc_id and text are one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import row_id, shown_id, small_or_shuffled, text_key, written

WINDOW = 5
PERCENT = 80
# Item windows that may be broadcast (about 40 bytes each); beyond, both sides are shuffled.
BROADCAST_WINDOWS = 500_000

# Unit words, in natural order.
UNITS = """
    mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram
    kilograms ounce ounces pound pounds lb lbs ton tons ml l litre litres liter liters
    gallon gallons second seconds minute minutes hour hours day days week weeks month months
    year years cent cents dollar dollars euro euros percent degree degrees volt volts watt
    watts mph kmh
""".split()

# Units whose forms differ by more than a final s.
FORMS = {
    "inches": "inch", "feet": "foot", "g": "gram", "kg": "kilogram", "lb": "pound", "lbs": "pound",
   "l": "liter", "litre": "liter", "litres": "liter",
}

NUMBER = r"\p{N}+(?:[.,:/-]\p{N}+)*"
UNIT = r"(?i)(?<=<n>\s?)(?:" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}\p{N}])"
# Capitalised words that begin sentences and are never names.
FUNCTION_WORDS = """
    The An This That These Those There Here It Its He She They We You His Her Their Our Your My
    If When While Where Which Who Whom Whose Why What How As At By For From In Into Of On Onto
    Over Under To With Without After Before Between During Since Until About And But Or Nor So
    Then Thus Hence Also However Because Although Though Each Every Some Any All Both Either
    Neither Many Much Most More Few Several Other Another Such No Not Now Only Is Are Was Were Be
    Do Does Did Has Have Had Can Could Will Would Shall Should May Might Must Let
""".split()
NAME = r"(?<!\S)(?!(?:" + "|".join(FUNCTION_WORDS) + r")(?![\p{L}'’-]))\p{Lu}[\p{L}'’-]+"
_BLANKS = r"[\x20\x09-\x0D]+"


def _tokens(text: Column) -> Column:
    return F.filter(F.split(text, _BLANKS), lambda w: w != "")


def _template(text: str) -> Column:
    marked = F.regexp_replace(text, NUMBER, "<n>")
    marked = F.when(F.col(text).rlike(r"\p{N}"), F.regexp_replace(marked, UNIT, "<u>")).otherwise(F.col(text))
    return F.lower(F.regexp_replace(marked, NAME, "<p>"))


def _value(kind: str, value: str) -> Column:
    """A slot's value as it is compared: units in one form, others as they stand."""
    unit = F.lower(value)
    form = F.regexp_replace(unit, "s$", "")
    for name, short in FORMS.items():
        form = F.when(unit == name, short).otherwise(form)
    return F.when(F.col(kind) == "<u>", form).otherwise(F.col(value))


def _windows(tokens: str) -> Column:
    hashes = f"transform(sequence(1, size({tokens}) - {WINDOW - 1}), i -> xxhash64(slice({tokens}, i, {WINDOW})))"
    return F.when(F.size(tokens) >= WINDOW, F.expr(hashes)).otherwise(F.expr("cast(array() AS array<bigint>)"))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(_item, _text, _ipos, _hash, _total): the windows of each item that count."""
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("_item"), F.coalesce("text", F.lit("")).alias("_text")
    ).distinct()
    tokens = items.withColumn("_tokens", _tokens(_template("_text")))
    literal = f"size(filter(slice(_tokens, _ipos + 1, {WINDOW}), t -> NOT t rlike '<[nup]>')) >= 2"
    windows = tokens.select("_item", "_text", "_tokens", F.posexplode(_windows("_tokens")).alias("_ipos", "_hash")).where(literal)
    totals = windows.groupBy("_item", "_text").agg(F.countDistinct("_hash").alias("_total"))
    return windows.select("_item", "_text", "_ipos", "_hash").join(
        totals.withColumnRenamed("_item", "_i").withColumnRenamed("_text", "_t"),
        F.col("_item").eqNullSafe(F.col("_i")) & (F.col("_text") == F.col("_t")),
    ).drop("_i", "_t")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(_id, _th, item_id, n_windows, item_windows, verbatim) of the items found in documents."""
    items = written(item_windows(benchmark).withColumn("_which", F.unhex(F.md5(F.col("_text").cast("binary")))))
    text = F.coalesce("text", F.lit(""))
    base = docs.select(row_id().alias("_id"), text_key().alias("_th"), text.alias("_text"))
    tokens = base.select("_id", "_th", _tokens(_template("_text")).alias("_tokens"))
    places = tokens.select("_id", "_th", F.posexplode(_windows("_tokens")).alias("_pos", "_hash"))
    keys = items.select("_item", "_which", "_ipos", "_hash", "_total")
    if keys.count() <= BROADCAST_WINDOWS:
        keys = F.broadcast(keys)
    met = places.join(keys, "_hash")
    key = ["_id", "_th", "_item", "_which"]
    diagonal = (F.col("_pos") - F.col("_ipos")).alias("_shift")
    # Rows that repeat a document meet the item twice; distinct windows are what counts.
    hits = written(met.select(*key, "_total", "_hash", "_pos", "_ipos", diagonal).distinct())
    suspected = (
        hits.groupBy(*key, "_total")
        .agg(F.countDistinct("_hash").alias("_n"))
        .where(100 * F.col("_n") >= PERCENT * F.col("_total"))
        .select(*key)
    )
    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in key]
    on = lambda a, b: F.expr("true") if not (parts := same(a, b)) else _all(parts)
    few = written(hits.alias("h").join(suspected.alias("s"), on("h", "s"), "left_semi"))
    wanted = small_or_shuffled(written(few.select("_id", "_th").distinct()))
    texts = base.join(wanted, ["_id", "_th"], "left_semi").dropDuplicates(["_id", "_th"])
    raw = texts.select("_id", "_th", _tokens(F.col("_text")).alias("_raw"))
    item_raw = items.select("_item", "_which", "_text").distinct().select(
        F.col("_item").alias("_i"), F.col("_which").alias("_w"),
        _tokens(F.col("_text")).alias("_item_raw"), _tokens(_template("_text")).alias("_item_tokens"),
    )
    slots = (
        few.join(raw, ["_id", "_th"])
        .join(item_raw, F.col("_item").eqNullSafe(F.col("_i")) & (F.col("_which") == F.col("_w")))
        .select(
            *key, "_shift",
            F.explode(F.expr(f"""
                filter(transform(sequence(0, {WINDOW - 1}), k -> struct(
                  regexp_extract(_item_tokens[_ipos + k], '<[nup]>', 0) AS kind,
                  regexp_replace(_item_raw[_ipos + k], '[^\\\\p{{L}}\\\\p{{N}}]+$', '') AS ours,
                  regexp_replace(_raw[_pos + k], '[^\\\\p{{L}}\\\\p{{N}}]+$', '') AS theirs)),
                  s -> s.kind <> '')
            """)).alias("_s"),
        )
        .select(*key, "_shift", "_s.*")
        .distinct()
    )
    along = [*key, "_shift"]
    values = slots.select(*along, "kind", _value("kind", "ours").alias("_o"), _value("kind", "theirs").alias("_t"))
    split = lambda a, b: values.groupBy(*along, "kind", a).agg(F.min(b).alias("_least"), F.max(b).alias("_most"))
    forth = split("_o", "_t").where("_least <> _most").select(*along)
    back = split("_t", "_o").where("kind = '<p>' AND _least <> _most").select(*along)
    changed = slots.where("ours <> theirs").select(*along).distinct()
    broken = forth.union(back).distinct()
    on_shift = lambda a, b: on(a, b) & (F.col(f"{a}._shift") == F.col(f"{b}._shift"))
    sound = few.alias("h").join(broken.alias("b"), on_shift("h", "b"), "left_anti")
    told = sound.alias("h").join(
        changed.withColumn("_changed", F.lit(True)).alias("c"), on_shift("h", "c"), "left"
    ).select("h.*", F.coalesce("_changed", F.lit(False)).alias("_changed"))
    return (
        told.groupBy(*key, "_total")
        .agg(F.countDistinct("_hash").alias("n_windows"), (~F.max("_changed")).alias("verbatim"))
        .where(100 * F.col("n_windows") >= PERCENT * F.col("_total"))
        .select("_id", "_th", F.col("_item").alias("item_id"), "n_windows", F.col("_total").alias("item_windows"), "verbatim")
    )


def _all(parts: list[Column]) -> Column:
    out = parts[0]
    for part in parts[1:]:
        out = out & part
    return out


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows, item_windows, verbatim: one row per item found in a document."""
    return matches(docs, benchmark).select(shown_id(), "item_id", "n_windows", "item_windows", "verbatim")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item was found, unchanged."""
    found = small_or_shuffled(written(matches(docs, benchmark).select("_id", "_th").distinct()))
    mine = docs.select(F.struct(*docs.columns).alias("_row"), row_id().alias("_id"), text_key().alias("_th"))
    return mine.join(found, ["_id", "_th"], "left_anti").select("_row.*")
