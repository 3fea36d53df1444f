"""Quality rules with adaptive thresholds per language and source.

Rates of every document go into mergeable sketches: histograms of integers cut to six significant bits, so a sketch has a bounded number
of cells, merges by adding counts, and gives each quantile to within 1/32 of its value. Sketches of a language
and source decide over its documents; where they hold too few, the merged sketches of the language, then those of everything, do.
A rate outside the fences around the median, scaled by the distance of an outer decile, fails the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.tables import stored

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Documents a sketch needs to decide; the factor on the distance between median and decile; the least distance, by rate.
MIN_DOCUMENTS = 100
FACTOR = 4
SLACK = {"word_length": 100, "symbols": 150, "dup_lines": 150, "repeats": 150, "capitals": 100}
#: Rates that are also fenced from below.
TWO_SIDED = ("word_length",)


def _repeated_words(triples: Column) -> Column:
    """Words covered by three-word windows that occur twice or more; ``triples``: sorted (window, position)."""
    twins = F.zip_with(triples, F.slice(triples, 2, F.greatest(F.size(triples), F.lit(0))), lambda a, b: F.when(a["w"] == b["w"], F.array(a["p"], b["p"])))
    return F.array_sort(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull()))))


def base_metrics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` with counts of each whole text; a null text has no words, lines or symbols."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    without = lambda column, characters: F.length(F.translate(column, characters, ""))
    lines = F.filter(F.split("text", "\n"), lambda line: without(line, SPACES) > 0)
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text.alias("text"))
    rows = rows.select(
        "doc_id", "lang", "source",
        F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "").alias("words"),
        lines.alias("lines"),
        without(F.col("text"), SPACES).alias("word_chars"),
        (F.length("text") - without(F.col("text"), SYMBOLS)).alias("n_symbols"),
        (F.length("text") - without(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("n_capitals"),
    )
    n_words = F.size("words")
    window = lambda i: F.struct(F.concat_ws(" ", *[F.get("words", i + k) for k in range(3)]).alias("w"), i.alias("p"))
    triples = F.when(n_words >= 3, F.transform(F.sequence(F.lit(0), n_words - 3), window)).otherwise(F.array())
    rows = rows.select(
        "doc_id", "lang", "source", n_words.cast("long").alias("n_words"),
        *[F.col(c).cast("long").alias(c) for c in ("word_chars", "n_symbols", "n_capitals")],
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(triples).alias("triples"),
    )
    rows = rows.withColumn("repeated", _repeated_words(F.col("triples"))).drop("triples")
    steps = F.zip_with("repeated", F.slice("repeated", 2, F.greatest(F.size("repeated"), F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    return rows.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)).drop("repeated")


def _rates() -> dict[str, Column]:
    """Whole numbers, mostly per thousand; never null, as counts are at least 1."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    part = lambda a, b, scale: F.floor(F.col(a) * scale / b).cast("long")
    return {
        "word_length": part("word_chars", words, 100), "symbols": part("n_symbols", words, 1000), "dup_lines": part("n_dup_lines", lines, 1000),
        "repeats": part("n_repeat_words", words, 1000), "capitals": part("n_capitals", chars, 1000),
    }


def sketch(rows: DataFrame) -> DataFrame:
    """``lang, source, rate, cell, n`` of rows with rates. Adding up ``n`` merges sketches; a hot source is one row per cell and task before the shuffle."""
    long = rows.select("lang", "source", F.explode(F.create_map(*[x for name in SLACK for x in (F.lit(name), F.col(name))])).alias("rate", "value"))
    drop = F.greatest(F.length(F.bin("value")) - 6, F.lit(0))
    cell = F.call_function("shiftleft", F.call_function("shiftright", F.col("value"), drop), drop)
    return long.groupBy("lang", "source", "rate", cell.alias("cell")).agg(F.count("*").alias("n"))


def quantiles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """``n, q10, q50, q90`` per group: the first cell at which the running count reaches the share."""
    order = Window.partitionBy(*keys).orderBy("cell")
    rows = cells.groupBy(*keys, "cell").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(order))
    rows = rows.withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    at = lambda percent: F.min(F.when(F.col("upto") * 100 >= F.col("total") * percent, F.col("cell")))
    return rows.groupBy(*keys).agg(F.max("total").alias("n"), *[at(p).alias(f"q{p}") for p in (10, 50, 90)])


def fences(cells: DataFrame, min_documents: int = MIN_DOCUMENTS, factor: int = FACTOR) -> DataFrame:
    """One row per language and source: ``low_<rate>`` and ``high_<rate>``, from the finest sketch with enough documents."""
    own = quantiles(cells, ["lang", "source", "rate"])
    tongue = quantiles(cells, ["lang", "rate"]).toDF("lang_", "rate_", "n1", "a10", "a50", "a90")
    every = quantiles(cells, ["rate"]).toDF("rate__", "n0", "b10", "b50", "b90")
    rows = own.join(tongue, F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("rate") == F.col("rate_"))).join(every, F.col("rate") == F.col("rate__"))
    pick = lambda p: F.when(F.col("n") >= min_documents, F.col(f"q{p}")).when(F.col("n1") >= min_documents, F.col(f"a{p}")).otherwise(F.col(f"b{p}"))
    slack = F.element_at(F.create_map(*[x for name, value in SLACK.items() for x in (F.lit(name), F.lit(value))]), F.col("rate"))
    high = pick(50) + F.greatest(factor * (pick(90) - pick(50)), slack)
    low = F.when(F.col("rate").isin(*TWO_SIDED), pick(50) - F.greatest(factor * (pick(50) - pick(10)), slack)).otherwise(F.lit(-1))
    rows = rows.select("lang", "source", "rate", low.alias("low"), high.alias("high"))
    bound = lambda name, end: F.max(F.when(F.col("rate") == name, F.col(end))).alias(f"{end}_{name}")
    return rows.groupBy("lang", "source").agg(*[bound(name, end) for name in SLACK for end in ("low", "high")])


def judged(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: counts, ``base_failed`` (few words, or most of them repeated) and ``kept``.

    Sketches hold all documents that pass the base rules. Null language and null source are groups like others.
    """
    rows = base_metrics(docs)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    rows = stored(rows.withColumns(_rates()).withColumn("base_failed", failed), "quality")
    limits = stored(fences(sketch(rows.where(~F.col("base_failed")))), "fences").withColumnsRenamed({"lang": "lang_", "source": "source_"})
    rows = rows.join(limits, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")), "left")
    inside = F.lit(True)
    for name in SLACK:
        inside = inside & F.col(name).between(F.col(f"low_{name}"), F.col(f"high_{name}"))
    return rows.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *SLACK, "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"))
