"""Document fingerprints by consistent weighted sampling, in DataFrame expressions alone.

A text's terms are its words, weighted by how often they occur. For each of `samples` samples every term draws
from its own hash two gamma variables r and c (shape 2) and a uniform b. A term of weight w then stands at
t = floor(ln w / r + b), and its race time is c * exp(-r * (t + 1 - b)). The winning (term, t) is the sample. Two
texts agree on a sample with the probability of their generalised Jaccard similarity, the sum of smaller weights
over the sum of larger ones.

Draws are exact: a gamma variable of shape 2 is the negative logarithm of a product of two uniforms, each of 32 bits of
the hash. The sample's name comes from bits that take no part in the race. Terms are made and raced in the task that
holds the text: nothing but fingerprints leaves it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import NO_ID, longs, range_of, ranges, tie

#: Samples that one row races for: more make a loop body that Java compiles less well.
GROUP = 8
#: What a text without words has in place of samples.
NOTHING = ""
#: Ranges of ids for each partition of a shuffle.
RANGES = 4


def terms(one: Column, two: Column) -> Column:
    """array<struct<h, one, two>>: hash of each different word of two texts, and how often either has it (null: never)."""
    # splitting at a single character is far quicker than at a pattern
    plain = lambda text: reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), "\t\n\x0b\x0c\r", text)
    words = lambda text, tag: F.transform(F.array_remove(F.split(plain(text), " "), ""), lambda x: F.xxhash64(x).bitwiseAND(-2) + tag)
    hashes = F.sort_array(F.concat(words(one, 0), words(two, 1)))  # the last bit says whose word it is
    heads = lambda a: F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: (i == 0) | (F.get(a, i) != F.get(a, i - 1)))

    def counted(a: Column, s: Column) -> Column:
        def term(x: Column, i: Column) -> Column:
            h, own, last = F.get(a, x), F.get(s, i + 1), F.size(a)
            after = F.coalesce(own, last)
            both = (h % 2 == 0) & F.coalesce(F.get(a, own) == h + 1, F.lit(False))
            more = F.coalesce(F.get(s, i + 2), last) - after
            one = F.when(h % 2 == 0, after - x)
            two = F.when(h % 2 != 0, after - x).when(both, more)
            dead = (h % 2 != 0) & (x > 0) & F.coalesce(F.get(a, x - 1) == h - 1, F.lit(False))
            return F.when(~dead, F.struct(h.bitwiseAND(-2).alias("h"), one.alias("one"), two.alias("two")))

        # the second text's entry of a word of both has gone into the first's
        return F.filter(F.transform(s, term), lambda x: x.isNotNull())

    bound = F.transform(F.array(hashes), lambda a: F.when(F.size(a) > 0, F.transform(F.array(heads(a)), lambda s: counted(a, s))[0]))
    return bound[0]


def gamma(x: Column) -> Column:
    """A gamma variable of shape 2 from a hash of 64 bits."""
    uniform = lambda bits: (bits + 0.5) / float(1 << 32)
    return -F.ln(uniform(x.bitwiseAND(0xFFFFFFFF)) * uniform(F.shiftrightunsigned(x, 32)))


def race(weight_log: Column, r: Column, log_c: Column, z: Column) -> Column:
    """Race time (high bits) and name (low 32 bits) of a term in one sample; null for a term without a weight."""
    b = F.shiftrightunsigned(z, 32) / float(1 << 32)
    t = F.floor(weight_log / r + b)
    time = ((log_c - r * (t + 1 - b)) * (1 << 24)).cast("long")
    name = (z + t * 0x9E3779B1).bitwiseAND(0xFFFFFFFF)
    return F.shiftleft(time, 32).bitwiseOR(name)


def fingerprint_terms(rows: DataFrame, keys: list[str], samples: int = 48) -> DataFrame:
    """keys, fingerprint and edited_fingerprint of each group of rows (keys, terms); a text of no terms has the fingerprint NOTHING.

    keys must hold the columns that rows are dealt by; then nothing is shuffled. samples: a multiple of GROUP.
    """
    logs = [F.ln(F.col(f"x.{c}").cast("double")).alias(c) for c in ("one", "two")]
    each = rows.select(*keys, F.explode_outer("terms").alias("x")).select(*keys, F.col("x.h").alias("h"), *logs)
    parts = each.select(*keys, "h", "one", "two", F.explode(F.sequence(F.lit(0), F.lit(samples // GROUP - 1))).alias("part"))
    raced = parts.select(*keys, "part", "one", "two", F.col("one").eqNullSafe(F.col("two")).alias("same"), F.xxhash64("h", "part").alias("h"))
    draw = lambda kind, j: F.xxhash64("h", F.lit(kind * GROUP + j))
    races = []
    for j in range(GROUP):
        # a weight of null takes no part, which min() sees to; most terms have one weight in both texts
        one, two = (race(F.col(c), gamma(draw(0, j)), F.ln(gamma(draw(1, j))), draw(2, j)) for c in ("one", "two"))
        races += [F.min(one).alias(f"one{j}"), F.min(F.when(F.col("same"), one).otherwise(two)).alias(f"two{j}")]
    best = raced.groupBy(*keys, "part").agg(*races)
    name = lambda c: F.coalesce(F.concat(*(F.lpad(F.lower(F.hex(F.when(F.col(f"{c}{j}").isNotNull(), F.xxhash64(F.col(f"{c}{j}").bitwiseAND(0xFFFFFFFF)).bitwiseAND(0xFFFF)))), 4, "0") for j in range(GROUP))), F.lit(NOTHING)).alias(c)
    named = best.select(*keys, "part", name("one"), name("two"))
    whole = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", c))), lambda x: x[c]), "")
    return named.groupBy(*keys).agg(whole("one").alias("fingerprint"), whole("two").alias("edited_fingerprint"))


def likeness(one: Column, two: Column) -> Column:
    """Share of samples that two fingerprints have in common; 1 for two texts without words, 0 for one."""
    samples = F.length(one) / 4
    same = F.filter(F.sequence(F.lit(1), samples.cast("int")), lambda k: F.substring(one, k * 4 - 3, F.lit(4)) == F.substring(two, k * 4 - 3, F.lit(4)))
    return F.when(one == two, 1.0).when((one == NOTHING) | (two == NOTHING), 0.0).otherwise(F.size(same) / samples)


def fingerprint_documents(docs: DataFrame, samples: int = 48) -> DataFrame:
    """doc_id, n_chars, fingerprint, edited_sha256, edited_fingerprint, near_edited, near_next of every row of docs.

    A row's edited text has its last floor(n_chars / 3) code points replaced by the first as many (or all) of the next
    row in descending order of doc_id; the first follows the last. Rows of equal doc_id follow each other in an order
    that a hash of their texts gives, and a null doc_id is less than any number. Each row has its own result, repeated
    rows too. A null text counts as empty. Other columns are ignored. A single row follows itself; an empty table gives
    an empty one.

    Texts are shuffled once, to ranges of ids (an id of very many rows has several ranges); the first row of a range goes
    to the range that precedes it as well. All that follows happens in the tasks that get them.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    count = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known, by_id = ranges(rows, count)
    known = known or [((NO_ID, 0), (NO_ID, 0))]
    rows = rows.withColumn("tie", tie(F.col("text")))
    place = F.lit(0).cast("long") if by_id else F.col("tie")
    own = rows.withColumn("own", range_of(F.col("doc"), place, [low for low, _ in known]))
    first = (F.col("doc") == F.get(longs([d for _, (d, _) in known]), "own")) & (place == F.get(longs([t for _, (_, t) in known]), "own"))
    places = F.array(F.struct(F.col("own").alias("range"), F.lit(False).alias("ghost")), F.when(first, F.struct(((F.col("own") + 1) % len(known)).alias("range"), F.lit(True).alias("ghost"))))
    dealt = own.select("doc", "tie", "text", F.explode(places).alias("p")).filter("p is not null").select("p.range", "p.ghost", "doc", "tie", "text").repartition("range")
    order = Window.partitionBy("range").orderBy("ghost", F.desc("doc"), F.desc("tie"), "text")
    pairs = dealt.withColumns({"place": F.row_number().over(order), "after": F.coalesce(F.lead("text").over(order), F.lit(""))})
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("after", F.lit(1), third))
    keys = ["range", "place", "ghost", "doc", "n_chars", "sha"]
    whole = pairs.select("range", "place", "ghost", "doc", n.cast("long").alias("n_chars"), F.unhex(F.sha2(edited, 256)).alias("sha"), terms(F.col("text"), edited).alias("terms"))
    found = fingerprint_terms(whole, keys, samples).withColumn("_next", F.lead("fingerprint").over(Window.partitionBy("range").orderBy("place")))
    return found.filter("not ghost").select(
        F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
    )
