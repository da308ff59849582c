"""Benchmark questions in documents, also with other numbers, names and units in them.

Texts become templates: numbers, units behind a number, and capitalised words turn into typed placeholders,
wherever they stand, the rest into lower-case words without punctuation. Runs of ``WINDOW`` template
words are hashed and joined with those of the benchmark. Where a matched run holds placeholders, the
document's values are laid beside the item's along the same alignment: where one value of the item stands
for two in the document, the runs that hold it don't count. Scripts without spaces are cut into characters.

An item is found in a document when ``SHARE`` of its runs are. Items of one run at most, or without a run of enough
literal words, are looked for as they stand, too, by runs of their lower-case words, values and arithmetic signs, and
found when all of these are. A document's words are made once for templates and, if there are such items, once as
they stand; runs of all lengths come from them in one pass. Only built-in functions are used. The benchmark's runs are broadcast if there are at most ``BROADCAST_ROWS`` of them, else the join is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.llm.common import matching, table, without
from scoremill.session import materialise

WINDOW = 8
#: Items of fewer words have no templates: so few words occur anywhere.
SHORTEST = 5
#: Words, values and signs of an item that is looked for as it stands, at least.
SHORTEST_EXACT = 1
#: Words in a run that are no placeholders, at least.
LITERALS = 4
SHARE = 0.3
BROADCAST_ROWS = 500_000

#: Private characters that mark number, unit and name, and a separator within a number.
NUMBER, UNIT, NAME, POINT = map(chr, range(0xE000, 0xE004))
MARKS = f"{NUMBER}{UNIT}{NAME}"
#: Units that may follow a number; words of a line mean the same unit.
SAME_UNIT = [
    line.split()
    for line in """
    percent
    mm millimeter millimeters millimetre millimetres
    cm centimeter centimeters centimetre centimetres
    m meter meters metre metres
    km kilometer kilometers kilometre kilometres
    mile miles mi
    foot feet ft
    inch inches
    yard yards yd
    mg milligram milligrams
    g gram grams
    kg kilogram kilograms
    pound pounds lb lbs
    ounce ounces oz
    ton tons
    ml milliliter milliliters millilitre millilitres
    l liter liters litre litres
    second seconds sec secs s
    minute minutes min mins
    hour hours hr hrs h
    day days
    week weeks
    month months
    year years
    dollar dollars
    cent cents
    euro euros
    degree degrees
    mph
    kmh
    kb
    mb
    gb
    """.strip().splitlines()
]
UNITS = [unit for line in SAME_UNIT for unit in line]
#: Scripts that put no spaces between words: each character is a word, with its marks.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\u30FC]\p{M}*"
SIGNS = "+*/=<>^%\u00d7\u00f7"


def template(text: Column, values: bool = False) -> Column:
    """Template words of a text; with ``values`` each placeholder is followed by what it replaced."""
    kept = "$0" if values else ""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{MARKS}{POINT}]+", " ")
    out = F.regexp_replace(out, r"(?<!\p{L})\p{Lu}\p{Ll}+(?!\p{L})", NAME + kept)
    out = F.lower(out)
    out = F.regexp_replace(out, r"(?<=\p{N})[.,:/](?=\p{N})", POINT)
    out = F.regexp_replace(out, rf"\p{{N}}[\p{{N}}{POINT}]*", f" {NUMBER}{kept} ")
    unit = "$2" if values else ""
    out = F.regexp_replace(out, rf"({NUMBER}[\p{{N}}{POINT}]*) +({'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", f"$1 {UNIT}{unit}")
    out = F.regexp_replace(out, rf"[^\p{{L}}\p{{N}}\p{{M}}{MARKS}{POINT}]+", " ")
    out = F.regexp_replace(out, UNSPACED, " $0 ")
    return F.filter(F.split(out, " "), lambda word: word != "")


def exact_words(text: Column) -> Column:
    """Words of a text in lower case, its numbers and its arithmetic signs."""
    out = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{MARKS}{POINT}]+", " "))
    out = F.regexp_replace(out, r"(?<=\p{N})[.,:/](?=\p{N})", POINT)
    out = F.regexp_replace(out, rf"[^\p{{L}}\p{{N}}\p{{M}}{POINT}{SIGNS}]+", " ")
    out = F.regexp_replace(out, rf"[{SIGNS}]|{UNSPACED}", " $0 ")
    return F.filter(F.split(out, " "), lambda word: word != "")


def _value(word: Column) -> Column:
    """A placeholder's value, units by the first word of their line."""
    same = F.create_map(*[F.lit(x) for line in SAME_UNIT for unit in line for x in (UNIT + unit, UNIT + line[0])])
    return F.coalesce(F.element_at(same, word), word)


def _runs(words: str, size: int) -> Column:
    picked = ", ".join(f"{words}[i + {k}]" for k in range(size))
    return F.expr(
        f"CASE WHEN size({words}) < {size} THEN array() "
        f"ELSE transform(sequence(0, size({words}) - {size}), i -> xxhash64({picked})) END"
    )


def _is_slot(word: Column) -> Column:
    return F.substring(word, 1, 1).isin(*MARKS)


def _own_runs(items: DataFrame, words: str, shortest: int, exact: bool) -> DataFrame:
    by_size = []
    for size in range(shortest, WINDOW + 1):
        own = items.where(F.size(words) >= size if size == WINDOW else F.size(words) == size)
        own = own.select("item_id", "item_key", words, F.posexplode(_runs(words, size)).alias("place", "run"))
        slots = F.size(F.filter(F.slice(words, F.col("place") + 1, size), _is_slot))
        shape = [F.lit(exact).alias("exact"), F.lit(size).alias("size")]
        by_size.append(own.select("item_id", "item_key", *shape, "place", "run", slots.alias("slots")))
    runs = by_size[0]
    for more in by_size[1:]:
        runs = runs.unionByName(more)
    return runs


def benchmark_runs(benchmark: DataFrame) -> DataFrame:
    """``item_id, item_key, exact, size, place, run, slots, n_runs`` of every run that is looked for."""
    text = F.col("text")
    items = benchmark.select("item_id", F.xxhash64("text").alias("item_key"), template(text).alias("_w"), exact_words(text).alias("_e"))
    items = materialise(items.distinct(), "items")
    runs = _own_runs(items, "_w", SHORTEST, False)
    runs = runs.where(F.col("size") - F.col("slots") >= F.least(F.lit(LITERALS), F.col("size")))
    templates = runs.where(F.col("size") == WINDOW).groupBy(F.col("item_id").alias("_i"), F.col("item_key").alias("_k"))
    several = templates.count().where("count > 1")
    same = F.col("item_id").eqNullSafe(F.col("_i")) & (F.col("item_key") == F.col("_k"))
    runs = runs.unionByName(_own_runs(items.join(several, same, "left_anti"), "_e", SHORTEST_EXACT, True))
    counts = runs.groupBy(F.col("item_id").alias("_i"), F.col("item_key").alias("_k"), F.col("exact").alias("_x"))
    counts = counts.agg(F.countDistinct("run").alias("n_runs"))
    runs = runs.join(counts, same & (F.col("exact") == F.col("_x"))).drop("_i", "_k", "_x")
    return materialise(runs, "benchmark")


def matched_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs of documents that occur in the benchmark: ``doc_id, text_key, at`` beside the item's."""
    shapes = [(r["exact"], r["size"]) for r in runs.select("exact", "size").distinct().collect()]  # a handful
    small = runs.count() <= BROADCAST_ROWS
    found = None
    for exact in sorted({exact for exact, _ in shapes} or {False}):
        sizes = sorted(size for kind, size in shapes if kind == exact) or [WINDOW]
        words = docs.select("doc_id", _key(docs), (exact_words if exact else template)(F.col("text")).alias("_w"))
        if len(sizes) == 1:
            placed = words.select("doc_id", "text_key", F.posexplode(_runs("_w", sizes[0])).alias("at", "run"))
            placed = placed.withColumn("_size", F.lit(sizes[0]))
        else:
            each = [F.struct(F.lit(size).alias("_size"), _runs("_w", size).alias("_runs")) for size in sizes]
            placed = words.select("doc_id", "text_key", F.inline(F.array(*each)))
            placed = placed.select("doc_id", "text_key", "_size", F.posexplode("_runs").alias("at", "run"))
        wanted = runs.where(F.col("exact") == exact)
        wanted = F.broadcast(wanted) if small else wanted
        joined = placed.join(wanted, (placed["run"] == wanted["run"]) & (F.col("_size") == F.col("size")))
        joined = joined.drop("_size").drop(placed["run"])
        found = joined if found is None else found.unionByName(joined)
    return found


def _key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["text"]).alias("text_key")


def inconsistent_slots(docs: DataFrame, benchmark: DataFrame, found: DataFrame) -> DataFrame:
    """Slots ``doc_id, text_key, item_id, item_key, shift, place`` whose item value stands for two in the document."""
    shift = (F.col("at") - F.col("place")).alias("shift")
    slotted = found.where(F.col("slots") > 0).select("doc_id", "text_key", "item_id", "item_key", shift, "place", "size").distinct()
    slotted = materialise(slotted, "slots")
    own = matching(docs.select("doc_id", "text"), slotted.select("doc_id", "text_key").distinct())
    own = own.select("doc_id", _key(own), "text")
    own = own.dropDuplicates(["doc_id", "text_key"]).select(
        F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), template(F.col("text"), True).alias("_w")
    )
    places = slotted.select(
        "doc_id", "text_key", "item_id", "item_key", "shift", F.explode(F.expr("sequence(place, place + size - 1)")).alias("place")
    ).distinct()
    said = places.join(own, places["doc_id"].eqNullSafe(F.col("_d")) & (places["text_key"] == F.col("_t")))
    said = said.select(
        "doc_id", "text_key", "item_id", "item_key", "shift", "place", F.get("_w", F.col("place") + F.col("shift")).alias("_said")
    ).where(_is_slot(F.col("_said")))
    asked = benchmark.distinct().select(F.col("item_id").alias("_i"), F.xxhash64("text").alias("_k"), F.posexplode(template(F.col("text"), True)).alias("_p", "_asked"))
    asked = asked.where(_is_slot(F.col("_asked")))
    same = said["item_id"].eqNullSafe(F.col("_i")) & (F.col("item_key") == F.col("_k")) & (F.col("place") == F.col("_p"))
    pairs = said.join(asked, same).withColumn("_said", _value(F.col("_said"))).withColumn("_asked", _value(F.col("_asked")))
    each = pairs.groupBy("doc_id", "text_key", "item_id", "item_key", "shift", "_asked").agg(
        F.countDistinct("_said").alias("said"), F.collect_set("place").alias("places")
    )
    each = each.where(F.col("said") > 1)
    return each.select("doc_id", "text_key", "item_id", "item_key", "shift", F.explode("places").alias("place"))


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_key, item_id, n_found, n_runs``: items found in documents, one row each.

    ``n_found`` counts an item's distinct runs; texts that share an ``item_id`` are items each. Null and empty texts hold no item and are none; rows that
    repeat in id and text give one row; a null ``doc_id`` or ``item_id`` is a value like others. Other
    columns are ignored. An empty benchmark finds nothing.
    """
    docs = docs.select("doc_id", "text")
    runs = benchmark_runs(benchmark.select("item_id", "text"))
    found = materialise(matched_runs(docs, runs), "matched-runs")
    bad = inconsistent_slots(docs, benchmark.select("item_id", "text"), found)
    bad = bad.select(*[F.col(c).alias(f"_{c}") for c in bad.columns])
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("item_id").eqNullSafe(F.col("_item_id"))
    same = same & (F.col("text_key") == F.col("_text_key")) & (F.col("item_key") == F.col("_item_key"))
    same = same & (F.col("at") - F.col("place") == F.col("_shift"))
    holds = F.col("_place").between(F.col("place"), F.col("place") + F.col("size") - 1)
    good = found.join(bad, same & holds & (F.col("slots") > 0), "left_anti")
    each = good.groupBy("doc_id", "text_key", "item_id", "item_key", "exact", "n_runs").agg(F.countDistinct("run").alias("n_found"))
    each = each.where(F.col("n_found") >= F.when(F.col("exact"), 1.0).otherwise(SHARE) * F.col("n_runs"))
    # An item found both ways is one row, with the larger share.
    best = F.max(F.struct(F.col("n_found") / F.col("n_runs"), "n_found", "n_runs")).alias("best")
    each = each.groupBy("doc_id", "text_key", "item_id", "item_key").agg(best)
    return each.select("doc_id", "text_key", "item_id", "best.n_found", "best.n_runs")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents in which an item is found."""
    return without(docs, find(docs, benchmark).select("doc_id", "text_key").distinct())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of ``benchmark`` found in all ``documents``; nulls, repeats and empty tables as in ``find``."""
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_found", "n_runs").distinct()
