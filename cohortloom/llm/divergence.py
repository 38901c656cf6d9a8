"""How far the sources of a language diverge in the terms that they use, by count-level bitmaps.

The terms of a language are ordered by frequency and cut into blocks of 64.  For each block, group
(language and source) and count there is one bitset with the terms that the group has so many times.  For two
groups and a block the AND of two bitsets has a bit for every term with these two counts; its popcount
times the divergence of the two shares adds up over blocks to the whole.

Terms that a group lacks have no bitset.  Their cells follow from the others: with all terms of one
group taken as lacking in the other the sum needs level sizes only, and a joint cell (a, b) corrects it by
f(a, b) - f(a, 0) - f(0, b) + f(0, 0).  So only bitsets that exist are joined.

All arithmetic is on whole numbers.  A language that holds most rows is spread by salt wherever its
name alone would be the key; the bitset join has the block in its key.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.text import parts, small_batches, utf8
from cohortloom.operators.numbering import number_rows
from cohortloom.session import durable

#: A term is kept if so many documents of the language have it; shares are in parts of SCALE; terms listed for a group.
DOCUMENTS, SCALE, LISTED = 10, 1_000_000_000, 10
#: Terms of all groups that a task counts before it hands them on.
COUNTED = 300_000
#: Pieces of a language where its name is the key.
SALTS = 16

#: A-Z in lower case, other ASCII as a space, all else as it is.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents; tasks count before anything is shuffled."""
    small_batches(docs.sparkSession)
    slim = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def rows(total):
        columns = [[], [], [], [], []]
        for (lang, source), terms in total.items():
            columns[0] += [lang] * len(terms)
            columns[1] += [source] * len(terms)
            columns[2] += terms.keys()
            columns[3] += [x[0] for x in terms.values()]
            columns[4] += [x[1] for x in terms.values()]
        total.clear()
        kinds = [pa.string()] * 3 + [pa.int64()] * 2
        columns[2] = [t.decode(errors="replace") for t in columns[2]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "source", "term", "n", "docs"])

    def run(batches):
        total, size = defaultdict(dict), 0
        for batch in parts(batches):
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))):
                terms = total[lang, source]
                before = len(terms)
                seen = set()
                for term in text.translate(_TERMS).split():
                    x = terms.get(term)
                    if x is None:
                        x = terms[term] = [0, 0]
                    x[0] += 1
                    if term not in seen:
                        seen.add(term)
                        x[1] += 1
                size += len(terms) - before
                if size > COUNTED:
                    yield rows(total)
                    size = 0
        yield rows(total)

    counted = slim.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _beside(rows: DataFrame, few: DataFrame, by: str, spread: str) -> DataFrame:
    """Join on the column `by` alone; rows of one value are dealt to SALTS pieces by `spread`, `few` is given to each."""
    salted = rows.withColumn("_salt", F.pmod(F.hash(spread), F.lit(SALTS)))
    copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [by, "_salt"]).drop("_salt")


def _whole(top: Column, bottom: Column) -> Column:
    return F.call_function("div", top, bottom)


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)); null without terms."""
    wide = [c.cast("decimal(18,0)") for c in (n, total, terms)]
    return 1 + _whole((wide[0] + 2) * F.lit(SCALE).cast("decimal(10,0)"), F.when(terms > 0, wide[1] + wide[2] * 2))


def divergence(p: Column, q: Column) -> Column:
    return _whole((p - q) * (p - q), p + q)


def kept_terms(counted: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """lang, term, block, bit, q (the language's share) of every term that enough of its documents have.

    Frequent terms come first, so terms of a block are about as frequent as each other and have few counts.
    """
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= documents)
    placed = number_rows(kept.select("lang", "term", "total", (-F.col("total")).alias("less")), ["lang", "less", "term"])
    placed = durable(placed.select("lang", "term", "total", (F.col("position") - 1).alias("place")), "terms")
    languages = placed.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("all"))
    return _beside(placed, languages, "lang", "term").select(
        "lang", "term", F.shiftrightunsigned("place", 6).alias("block"), F.pmod("place", F.lit(64)).cast("int").alias("bit"),
        share(F.col("total"), F.col("all"), F.col("terms")).alias("q"), "terms",
    )


def _pair_sums(groups: DataFrame, levels: DataFrame, sizes: DataFrame) -> DataFrame:
    """lang, lo, hi, value: the divergence of each two groups of a language, summed over all kept terms."""
    none = groups.join(sizes.groupBy("lang", "source").agg(F.sum("size").alias("has")), ["lang", "source"], "left")
    none = none.select("lang", "source", F.col("zero").alias("p"), "zero", (F.col("terms") - F.coalesce("has", F.lit(0))).alias("size"))
    every = none.union(sizes.select("lang", "source", "p", "zero", "size"))
    others = groups.select("lang", F.col("source").alias("other"), F.col("zero").alias("other_zero"))
    lacking = _beside(every, others, "lang", "source").where("source != other")
    without = divergence(F.col("p"), F.col("other_zero"))
    only = F.when(F.col("source") < F.col("other"), without).otherwise(without - divergence(F.col("zero"), F.col("other_zero")))
    alone = lacking.select("lang", F.least("source", "other").alias("lo"), F.greatest("source", "other").alias("hi"), (only * F.col("size")).alias("value"))
    a, b = (levels.select("lang", "block", *[F.col(c).alias(f"{c}_{x}") for c in ("source", "p", "zero", "bits")]) for x in "ab")
    cells = F.bit_count(F.col("bits_a").bitwiseAND(F.col("bits_b")))
    met = a.join(b, ["lang", "block"]).where((F.col("source_a") < F.col("source_b")) & (F.col("bits_a").bitwiseAND(F.col("bits_b")) != 0))
    p, q, zp, zq = (F.col(c) for c in ("p_a", "p_b", "zero_a", "zero_b"))
    correction = divergence(p, q) - divergence(p, zq) - divergence(zp, q) + divergence(zp, zq)
    both = met.select("lang", F.col("source_a").alias("lo"), F.col("source_b").alias("hi"), (cells * correction).alias("value"))
    return alone.union(both).groupBy("lang", "lo", "hi").agg(F.coalesce(F.sum("value"), F.lit(0)).alias("value"))


def audit(docs: DataFrame, documents: int = DOCUMENTS, listed: int = LISTED) -> DataFrame:
    """lang, source, part, item, value, rank: other sources by divergence, and the terms that set a source apart.

    Part `pair` has every other source of the language, part `term` the first `listed` terms that the
    group has and whose share there is above the language's.  Null text, lang and source count as '';
    repeated rows count again; a group without terms has its pairs, with value 0 where the language keeps no
    term; an empty table gives no rows; further columns are not read.  A text is counted whole in one
    task, and what a task remembers is bounded.
    """
    counted = durable(count_terms(docs), "counts")
    kept = durable(kept_terms(counted, documents), "kept")
    known = durable(counted.join(kept.select("lang", "term", "block", "bit", "q"), ["lang", "term"]).drop("docs"), "known")
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    languages = kept.groupBy("lang").agg(F.max("terms").alias("terms"))
    totals = known.groupBy("lang", "source").agg(F.sum("n").alias("all"))
    groups = named.join(languages, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.select("lang", "source", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("all", F.lit(0)).alias("all"))
    groups = durable(groups.withColumn("zero", share(F.lit(0), F.col("all"), F.col("terms"))), "groups")

    counts = known.groupBy("lang", "source", "n").agg(F.count("*").alias("size")).join(groups, ["lang", "source"])
    sizes = durable(counts.select("lang", "source", "n", "size", "zero", share(F.col("n"), F.col("all"), F.col("terms")).alias("p")), "levels")
    bits = known.groupBy("lang", "source", "n", "block").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
    levels = durable(bits.join(sizes.drop("size"), ["lang", "source", "n"]), "bitmaps")

    sums = _pair_sums(groups, levels, sizes)
    ways = F.explode(F.array(F.struct(F.col("lo").alias("source"), F.col("hi").alias("item")), F.struct(F.col("hi").alias("source"), F.col("lo").alias("item"))))
    pairs = sums.select("lang", ways.alias("w"), "value").select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")
    own = known.join(sizes.select("lang", "source", "n", "p"), ["lang", "source", "n"]).where("p > q")
    terms = own.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    first = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= listed)
    return pairs.withColumn("rank", F.row_number().over(order)).union(first)
