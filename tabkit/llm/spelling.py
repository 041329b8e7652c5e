"""Spelling variants: words one edit apart, found by sorting permuterm rotations.

A word ``w`` is marked with a terminator and turned: ``rotation(i) = w[i:] + END + w[:i]``. In
the rotation that starts just after code point ``p`` the code point ``p`` stands last, so

* words that differ from ``w`` by a replacement at ``p`` share that rotation but for its last
  code point: they are a prefix range of the sorted rotations, the prefix skipping the edited
  code point;
* the word without code point ``p`` has the prefix itself as a whole rotation: it heads the range.

Every rotation is sorted once, by (prefix, count), and the ranges are scanned. A range holds one
word for each last code point and one whole rotation, so its length is bounded by the alphabet.
Neighbours are counted and the most frequent one is picked within the range: no pair of words is
ever a row. A word of a run (``aab`` without either ``a`` is ``ab``) meets its shorter neighbour
in several ranges; only the range that skips the last code point of the run counts it.

``forms``: a word's form is its neighbour of largest count (ties: the smallest word in code
point order) if that count is at least ``ratio`` times its own; the root is where its forms
lead. Each step multiplies the count by ``ratio``, so chains are at most log(largest count)
long and are followed by doubling.

Defined results: NULL texts and texts without words give none; a NULL doc_id counts as the empty
string where ``runs`` gives it on; texts of any length are read whole; repeated rows count each
time; equal counts are settled by code point order; an empty table gives an empty result; only
``doc_id`` and ``text`` are read, so other columns may have any name. Words must not hold U+0000.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabkit.llm.common import written

#: Marks the end of a word in its rotations; sorts before every code point of a word.
END = "\u0000"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lower-cased letters that make up words.
LETTERS = "a-zÀ-ÿ"


def runs(docs: DataFrame, shortest: int) -> DataFrame:
    """(doc_id string, run): the maximal runs of letters with at least ``shortest`` code points,
    A-Z lower-cased, one row for each occurrence."""
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    found = F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{int(shortest)},}}"), F.lit(0))
    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(found).alias("run"))


def count_words(words: DataFrame, shortest: int, least: int) -> DataFrame:
    """(word, n) of the words of at least ``shortest`` code points that occur ``least`` times or more."""
    long_enough = words.filter(F.char_length("word") >= shortest)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def rotations(counts: DataFrame) -> DataFrame:
    """(prefix, last, n): each word's rotations, whole (``last`` is empty) and with the last code
    point split off."""
    end, size = F.lit(END), F.char_length("word")
    cut = lambda a, n: F.substring(F.col("word"), a.cast("int"), n.cast("int"))

    def whole(i: Column) -> Column:
        return F.struct(F.concat(cut(i + 1, size), end, cut(F.lit(1), i)).alias("prefix"), F.lit("").alias("last"))

    def split(p: Column) -> Column:
        return F.struct(F.concat(cut(p + 2, size), end, cut(F.lit(1), p)).alias("prefix"), cut(p + 1, F.lit(1)).alias("last"))

    each = F.concat(F.transform(F.sequence(F.lit(0), size), whole), F.transform(F.sequence(F.lit(0), size - 1), split))
    return counts.filter(size > 0).select("n", F.inline(each)).select("prefix", "last", "n")


def neighbours(counts: DataFrame) -> DataFrame:
    """(word, n_near, best): for each word with a neighbour the number of words one edit away
    and the struct (minus count, word) of the most frequent one."""
    group = Window.partitionBy("prefix").orderBy(F.desc("n"), "last").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    is_whole = F.col("last") == ""
    # the last code point of a run of equal ones: what follows the skipped code point is another
    ends_run = ~is_whole & (F.substring("prefix", 1, 1) != F.col("last"))
    other = F.struct("n", "last")
    scanned = rotations(counts).select(
        "prefix", "last", "n", is_whole.alias("whole"), ends_run.alias("ends_run"),
        F.count_if(~is_whole).over(group).alias("n_split"), F.count_if(ends_run).over(group).alias("n_ends"),
        F.max(F.when(is_whole, F.col("n"))).over(group).alias("whole_n"),
        F.first(F.when(~is_whole, other), ignorenulls=True).over(group).alias("first"),
        F.nth_value(F.when(~is_whole, other), 2, ignoreNulls=True).over(group).alias("second"),
        F.first(F.when(ends_run, other), ignorenulls=True).over(group).alias("first_end"))
    shorter = F.col("ends_run") & F.col("whole_n").isNotNull()
    near = F.when(F.col("whole"), F.col("n_ends")).otherwise(F.col("n_split") - 1 + shorter.cast("long"))
    start, rest = F.substring_index("prefix", END, -1), F.substring_index("prefix", END, 1)

    def named(n: Column, last: Column) -> Column:
        return F.when(n.isNotNull(), F.struct((-n).alias("minus"), F.concat(start, last, rest).alias("word")))

    longer = named(F.col("first_end.n"), F.col("first_end.last"))
    pick = F.when(F.col("first.last") == F.col("last"), F.col("second")).otherwise(F.col("first"))
    replaced = named(pick["n"], pick["last"])
    best = F.when(F.col("whole"), longer).otherwise(F.least(replaced, F.when(shorter, named(F.col("whole_n"), F.lit("")))))
    found = scanned.filter(near > 0).select(F.concat(start, "last", rest).alias("word"), near.alias("near"), best.alias("best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame, hops: int) -> DataFrame:
    """(word, root) from (word, form): where a chain of at most ``hops`` forms ends, by doubling."""
    at = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(hops)) if hops > 1 else 0):
        at = written(at, "spelling-roots")
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return at


def variants(counts: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``counts`` (word, n); words are distinct."""
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    counts = written(counts.select("word", "n"), "spelling-counts")
    largest, smallest = counts.agg(F.max("n"), F.min("n")).first()
    hops = int(math.log(largest / max(smallest, 1)) / math.log(ratio) + 1e-9) if largest else 0
    near = neighbours(counts)
    joined = counts.join(near, "word", "left")
    better = -F.col("best.minus") >= ratio * F.col("n")
    found = written(joined.select(
        "word", F.when(better, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(better, -F.col("best.minus")).alias("form_n")), "spelling-forms")
    ends = roots(found.filter(F.col("form").isNotNull()), hops)
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
