"""Groups of spelling variants: words one inserted, deleted or replaced letter apart, found by PartEnum signatures.

The letters of a word are a binary vector: one dimension per letter and occurrence (first e, second e, ...). One edit changes at most two
dimensions, so near words have vectors at Hamming distance two at most. The dimensions are partitioned into five parts; two such
vectors agree in at least three of them. All ten choices of three parts are enumerated, each giving an exact signature; near words share at least
one. As a vector knows no order, a signature is taken once with the first three letters of the word and once with its last three: one edit
leaves one of the two ends as it is. These keys meet by an equi-join, a pair is formed at the first key it shares, and the edit distance decides.

A key of more words than ``WIDE`` is divided further, exactly: its words meet where they are equal without one letter,
which at most an alphabet of words can be. So no key gives a number of pairs that grows with the square of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import stored
from starloom.llm.words import mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[a-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
DAMAGE = 31
PARTS, DISTANCE, PART_BITS = 5, 2, 11
END = 3
WIDE = 256
#: Bits of the parts that each signature keeps.
MASKS = [sum(((1 << PART_BITS) - 1) << (PART_BITS * part) for part in chosen) for chosen in combinations(range(PARTS), PARTS - DISTANCE)]
_BASE = 0xD1342543DE82EF95
_ROWS_BYTES = 1 << 23


def observed_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: runs of letters of all whole texts, A-Z lower-cased, with their number of occurrences.

    Where 31 divides the checksum of ``<doc_id>:<run>``, the run loses the letter at that checksum's place. A null doc_id counts as an
    empty string, a null text as no run. Shorter runs go before anything is counted, as a run never gets longer.
    """
    text = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= least_length).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % DAMAGE == 0, damaged).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _letter_order(words: DataFrame) -> str:
    """Letters of the vocabulary, most words first: neighbours in this order go to different parts. At most the alphabet reaches the driver."""
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).groupBy("letter").count()
    return "".join(row.letter for row in letters.orderBy(F.col("count").desc(), "letter").collect())


def vector_codes(words: pa.Array, order: str) -> np.ndarray:
    """Per word the parts of its vector, hashed to ``PART_BITS`` each, in one number."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    letters = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    by_letter = np.lexsort((letters, owner))
    letters, owner = letters[by_letter], owner[by_letter]
    fresh = np.ones(len(letters), dtype=bool)
    fresh[1:] = (letters[1:] != letters[:-1]) | (owner[1:] != owner[:-1])
    at = np.arange(len(letters))
    seen = at - np.maximum.accumulate(np.where(fresh, at, 0))  # 0 for the first occurrence of a letter in its word
    rank = np.zeros(1 + max(map(ord, order), default=0), dtype=np.int64)
    rank[[ord(c) for c in order]] = np.arange(len(order))
    part = (rank[letters] + 3 * seen) % PARTS
    value = mix((letters + (seen << 32)).astype(np.uint64)) & np.uint64((1 << PART_BITS) - 1)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return np.bitwise_xor.reduceat(value << (part * PART_BITS).astype(np.uint64), starts).astype(np.int64)


def coded(words: DataFrame) -> DataFrame:
    """Words with the codes of their vectors."""
    order = _letter_order(words)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(vector_codes(batch.column(0), order)), *batch.columns], names=["code", "word", "n"])

    return words.select("word", "n").mapInArrow(code, "code long, word string, n long")


def signatures(codes: DataFrame) -> DataFrame:
    """``key, slot, code, word, n``: 20 rows a word, one for each signature and each end."""
    ends = (F.substring("word", 1, END), F.substring("word", -END, END))
    slots = [F.struct(F.xxhash64(F.lit(2 * i + k), F.col("code").bitwiseAND(F.lit(mask)), end).alias("key"), F.lit(2 * i + k).alias("slot")) for i, mask in enumerate(MASKS) for k, end in enumerate(ends)]
    return codes.select(F.inline(F.array(*slots)), "code", "word", "n")


def _first_shared() -> Column:
    """Number of the first key that words a and b share."""
    apart = F.col("a_code").bitwiseXOR(F.col("b_code"))
    signature = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(mask)) == 0, F.lit(i)) for i, mask in enumerate(MASKS)])
    return 2 * signature + F.when(F.substring("a_word", 1, END) == F.substring("b_word", 1, END), 0).otherwise(1)


def _without_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """New rows of words under a wide key: a word without each of its letters, by a hash that is linear in the word's length.

    Role 0 meets itself (a replaced letter at one place), role 1, the word as it is, meets role 2, words with one letter more.
    """
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    for batch in batches:
        picks, keys, roles, size = [], [], [], 0

        def rows() -> pa.RecordBatch:
            taken = batch.take(pa.array(np.concatenate(picks)))  # noqa: B023
            key, role = pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(roles))  # noqa: B023
            return pa.RecordBatch.from_arrays([key, *taken.columns[1:], role], names=[*taken.schema.names, "role"])

        for row, (wide, word) in enumerate(zip(batch.column("key").to_pylist(), batch.column("word").to_pylist(), strict=True)):
            letters = mix(np.frombuffer(word.encode("utf-32-le"), dtype="<u4").astype(np.uint64))
            steps = np.full(len(letters), _BASE, dtype=np.uint64)
            steps[0] = 1
            sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(letters * np.multiply.accumulate(steps))])
            short = sums[:-1] + (sums[-1] - sums[1:]) * inverse
            salt = mix(np.array([wide], dtype=np.int64).view(np.uint64))
            places = mix(np.arange(1, len(letters) + 1, dtype=np.uint64))
            for role, found in ((0, mix(short + salt) ^ places), (1, mix(sums[-1:] + salt)), (2, np.unique(mix(short + salt)))):
                keys.append(found)
                roles.append(np.full(len(found), role, dtype=np.int32))
                picks.append(np.full(len(found), row, dtype=np.int64))
                size += len(found) * (len(word) + 32)
            if size > _ROWS_BYTES:
                yield rows()
                picks, keys, roles, size = [], [], [], 0
        if picks:
            yield rows()


def near_pairs(words: DataFrame, wide: int = WIDE) -> DataFrame:
    """``a, a_n, b, b_n`` for all pairs of words at edit distance one, each once and with a before b."""
    rows = signatures(stored(coded(words), "coded-words"))
    crowds = rows.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > wide)
    crowded = stored(crowds.select("key"), "wide-keys")
    fine = rows.join(crowded, "key", "left_semi").mapInArrow(_without_one, "key long, slot int, code long, word string, n long, role int")
    met = rows.join(crowded, "key", "left_anti").withColumn("role", F.lit(0)).unionByName(fine)
    left, right = (met.select("key", "slot", *[F.col(c).alias(f"{side}_{c}") for c in ("code", "word", "n", "role")]) for side in ("a", "b"))
    # One condition over both sides: a part of it pushed to one side would make the sides differ, and each would be shuffled.
    paired = F.when(F.col("a_role") + F.col("b_role") == 0, F.col("a_word") < F.col("b_word")).otherwise(3 * F.col("a_role") + F.col("b_role") == 5)
    met = left.join(right, ["key", "slot"]).where(paired)
    met = met.where(F.col("slot") == _first_shared())
    met = met.where(F.levenshtein("a_word", "b_word", 1) == 1)
    turned = F.col("a_word") > F.col("b_word")
    pick = lambda c: F.when(turned, F.col(f"b_{c}")).otherwise(F.col(f"a_{c}")).alias("a" if c == "word" else "a_n")
    other = lambda c: F.when(turned, F.col(f"a_{c}")).otherwise(F.col(f"b_{c}")).alias("b" if c == "word" else "b_n")
    return met.select(pick("word"), pick("n"), other("word"), other("n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words that have a form; each round doubles the steps taken, and a step takes counts up tenfold."""
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        later = found.select(F.col("word").alias("root"), F.col("root").alias("later"))
        moved = stored(found.join(later, "root", "left").select("word", F.coalesce("later", "root").alias("root"), F.col("later").isNotNull().alias("moved")), "roots")
        if not moved.where("moved").head(1):
            return moved.drop("moved")
        found = moved.drop("moved")


def spelling_variants(docs: DataFrame, wide: int = WIDE, ratio: int = RATIO) -> DataFrame:
    """Per word ``word, n, n_near, form, form_n, root``.

    ``form`` is the near word with the most occurrences (ties: first in code-point order) if it has ``ratio`` times the word's own,
    else null; ``root`` is where following forms ends. Rows of ``docs`` count one by one, also where they repeat. No rows, or no words, give no rows.
    """
    words = stored(observed_words(docs), "words")
    pairs = stored(near_pairs(words, wide), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("top"))
    formed = F.coalesce(-F.col("top.rank") >= ratio * F.col("n"), F.lit(False))
    found = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("top.near")).alias("form"),
        F.when(formed, -F.col("top.rank")).alias("form_n"),
    )
    found = stored(found, "forms")
    return found.join(_roots(found.where("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word"))
