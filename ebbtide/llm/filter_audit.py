"""Operator 11: what five document filters remove in every order, alone and together.

The failures of filters A to D are one projection of the text. E, "identical to the text of a smaller doc_id", is an
existential self-join: a left-semi join on hash, exact text and smaller doc_id. The documents marked by it are united
with the other failures, one bit combination is formed per document, and combinations are counted per part. All 120
orders are then read off the counts: at most 128 combinations a part, however many documents there are.

Texts take no part in a shuffle but those whose hash is not unique. Of a text that many documents share, the inner side
of the semi join holds one row, its smallest doc_id; the documents that share it are dealt into parts of about
``PART``, so a text that a third of all documents hold fills no single task.

Null and empty texts are empty texts and equal to each other; a null source is the part named by the empty string. Each
row counts as a document, repeated rows too. Rows with a null doc_id take part in A to D; no id is smaller than theirs
and theirs is smaller than none, and they have no labels. A document with several label rows is good or toxic if any of
them says so. A table without rows gives no rows. Columns other than doc_id, text and source are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import staged

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # distinct words per hundred words
MOST_CAPITALS = 2  # capitals per hundred characters
SYMBOLS = r"[#$%&*|]"
_BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}
GOOD, TOXIC = 32, 64
PART = 1_000  # documents that share one text are dealt into parts of about this many
BROADCAST_ROWS = 1_000_000  # hashes held by several documents are broadcast up to this many (8 bytes each)


def failure_bits(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    few = F.size(words) < LEAST_WORDS
    repeated = 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    shouting = 100 * capitals > MOST_CAPITALS * F.length(text)
    failed = {"A": few, "B": repeated, "C": shouting, "D": text.rlike(SYMBOLS)}
    bits = [F.when(fails, F.lit(_BIT[letter])).otherwise(F.lit(0)) for letter, fails in failed.items()]
    return bits[0] + bits[1] + bits[2] + bits[3]


def text_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text, hash) with nulls replaced, and nothing else of the table."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("hash")
    )


def copies_of_smaller_ids(rows: DataFrame, held: DataFrame) -> DataFrame:
    """(doc_id, part, hash) of the rows whose text a smaller doc_id has, once each.

    ``held`` are the same rows without texts; its hashes that occur once need no look at the text.
    """
    shared = held.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / PART).cast("int").alias("parts")
    shared = staged(shared.select(F.col("hash").alias("shared_hash"), parts), "shared-hashes")
    hint = "broadcast" if shared.count() <= BROADCAST_ROWS else "shuffle_hash"
    with_id = rows.where(F.col("doc_id").isNotNull())
    alike = with_id.join(shared.hint(hint), F.col("hash") == F.col("shared_hash")).drop("shared_hash")
    first = alike.groupBy("hash", "text", "parts").agg(F.min("doc_id").alias("first_id"))
    first = first.select(
        F.col("hash").alias("h"), F.col("text").alias("t"), "first_id",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"),
    )
    dealt = alike.withColumn("dealt", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    same = (F.col("hash") == F.col("h")) & (F.col("dealt") == F.col("p")) & (F.col("text") == F.col("t"))
    marked = dealt.join(first, same & (F.col("first_id") < F.col("doc_id")), "left_semi")
    return marked.select("doc_id", "part", "hash").distinct()


def bit_combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n): documents of a part by the filters that they fail, and by ``GOOD`` and ``TOXIC``."""
    rows = text_rows(docs)
    held = staged(rows.select("doc_id", "part", "hash", failure_bits(F.col("text")).alias("bits")), "failures")
    marked = copies_of_smaller_ids(rows, held).withColumns({"bits": F.lit(_BIT["E"]), "n": F.lit(0)})
    united = held.withColumn("n", F.lit(1)).unionByName(marked)
    per_document = united.groupBy("doc_id", "part", "hash").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    judged = labels.groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int") * GOOD).alias("good"),
        F.max((F.col("toxic") == 1).cast("int") * TOXIC).alias("toxic"),
    )
    joined = per_document.join(judged, F.col("doc_id") == F.col("labelled"), "left")
    bits = F.col("bits") + F.coalesce("good", F.lit(0)) + F.coalesce("toxic", F.lit(0))
    return joined.groupBy("part", bits.alias("bits")).agg(F.sum("n").alias("n"))


def all_steps() -> dict[str, Column]:
    """Every step of every order as array literals: filter_order, step, and the bits of its filter and of earlier ones."""
    steps = [
        ("".join(order), step, _BIT[order[step - 1]], sum(_BIT[letter] for letter in order[: step - 1]))
        for order in permutations(FILTERS)
        for step in range(1, len(FILTERS) + 1)
    ]
    types = {"filter_order": "string", "step": "int", "me": "int", "before": "int"}
    # the optimizer splits each string once
    return {
        name: F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{types[name]}>")
        for name, values in zip(types, zip(*steps))
    }


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with the documents that it keeps, removes and loses."""
    counted = staged(bit_combinations(docs, labels), "combinations")
    filters = sum(_BIT.values())
    bits, me, before, n = (F.col(c) for c in ("bits", "me", "before", "n"))
    failed, early = bits.bitwiseAND(me) > 0, bits.bitwiseAND(before) > 0
    removed = failed & ~early

    def total(condition: Column, weight: Column = n) -> Column:
        return F.sum(F.when(condition, weight).otherwise(F.lit(0))).cast("long")

    measures = {
        "kept": total(~failed & ~early),
        "removed": total(removed),
        "redundant": total(failed & early),
        "unique_fails": total(bits.bitwiseAND(F.lit(filters)) == me),
        "good_lost": total(removed & (bits.bitwiseAND(F.lit(GOOD)) > 0)),
        "toxic_lost": total(removed & (bits.bitwiseAND(F.lit(TOXIC)) > 0)),
        # in a share of 1 / k of all orders the filter is the first of the k that fail
        "shapley": total(failed, n * (F.lit(120) / F.bit_count(bits.bitwiseAND(F.lit(filters)))).cast("long")),
    }
    steps = all_steps()
    expanded = counted.select("part", "bits", "n", F.posexplode(steps.pop("filter_order")).alias("at", "filter_order"))
    expanded = expanded.withColumns({name: F.get(values, F.col("at")) for name, values in steps.items()})
    return expanded.groupBy("part", "filter_order", "step").agg(*[m.alias(name) for name, m in measures.items()])
