"""Secret scan with multipart credential linking, in DataFrame functions only.

Base kinds (``assign``, ``access``, ``hex``) are matched leftmost and non-overlapping per
kind over the whole text. A credential of several parts often has parts too weak to report
alone: a bare 40-character secret, or an endpoint. Such weak candidates (``secret``,
``endpoint``) are reported only where a complementary part lies in the same scope: every
strong part opens a scope of SCOPE code points to either side, and an interval join of
scopes with candidates (equal row key and position bin, then the exact bounds) keeps the
candidates that meet one. An access identifier complements a secret or an endpoint, an
assigned secret complements an endpoint.

Positions are code points, end exclusive. A text is cut at its matches with ``split``; the
running lengths of gaps and matches are the positions. The sums run over runs of entries, so the
work on a text grows with its matches, not with their square.

Defined results: a NULL text counts as empty and has no spans; a NULL doc_id is kept;
repeated rows get equal results; an empty table gives an empty result. Very long texts are
scanned whole. Spans that start together are ordered by kind. Other columns of the table may
have any name: they stay inside one struct, beside which the scan's own columns stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabkit.llm.common import written

# Fixed values of the scan: the kinds, their patterns, the shortest match kept.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
# Candidates that count only beside a complementary part.
SECRET = r"(?<![A-Za-z0-9+/=])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = r"(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:@%/?#&=+-]+"
KINDS = ("assign", "access", "hex", "secret", "endpoint")
#: Which kinds open a scope for which weak kind.
COMPLEMENTS = {"secret": ("access",), "endpoint": ("access", "assign")}
#: Code points that a scope reaches to either side of a strong part.
SCOPE = 256
#: Entries of an array that are summed one by one, and code points of a page of a text that is cut.
RUN, PAGE = 64, 512

SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def before(values: Column, zero: int, merge, levels: int = 2) -> Column:
    """For each entry of an array of longs the ``merge`` of all entries before it (``zero`` for the
    first). An array grown entry by entry is copied at every step, so it is grown only within runs of
    RUN entries; the results of whole runs go through the same function, one level up."""
    zero_ = F.lit(zero).cast("long")
    if not levels:
        return F.aggregate(
            values, F.struct(zero_.alias("now"), F.array().cast("array<bigint>").alias("out")),
            lambda a, x: F.struct(merge(a["now"], x).alias("now"), F.concat(a["out"], F.array(a["now"])).alias("out")),
            lambda a: a["out"])

    def over(v):
        starts = F.sequence(F.lit(0), F.floor(F.greatest(F.size(v) - 1, F.lit(0)) / RUN).cast("int"))
        return let(F.transform(starts, lambda i: F.slice(v, i * RUN + 1, F.lit(RUN))), by_run)

    def by_run(runs):
        offsets = before(F.transform(runs, lambda r: F.aggregate(r, zero_, merge)), zero, merge, levels - 1)
        return F.flatten(F.zip_with(runs, offsets, lambda r, o: F.transform(
            before(r, zero, merge, 0), lambda x: merge(x, o))))

    return let(values, over)


def spans(text: Column, kind: str, pattern: str, has: Column, shortest: int = 0, group: int = 0) -> Column:
    """Array of (start, kind number, end) of the pattern's matches in ``text``."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.char_length)
    if group:
        kept = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.char_length)
        found = F.zip_with(found, kept, lambda m, v: F.struct(m.alias("m"), v.alias("v")))
    else:
        found = F.transform(found, lambda m: F.struct(m.alias("m"), m.alias("v")))
    # one gap more than matches: the last one stands beside a NULL match
    parts = F.filter(F.zip_with(F.split(text, pattern, -1), found, lambda g, x: F.struct(
        F.char_length(g).cast("long").alias("g"), x["m"].cast("long").alias("m"), x["v"].alias("v"))), lambda x: x["m"].isNotNull())

    def placed(items):
        ends = before(F.transform(items, lambda x: x["g"] + x["m"]), 0, lambda a, x: a + x)
        at = F.zip_with(items, ends, lambda x, e: F.struct(
            (e + x["g"]).alias("start"), (e + x["g"] + x["m"]).alias("end"), x["v"].alias("v")))
        return F.transform(F.filter(at, lambda x: x["v"] >= shortest), lambda x: F.struct(
            x["start"], F.lit(KINDS.index(kind)).alias("kind"), x["end"]))

    return F.when(has, let(parts, placed)).otherwise(F.array()).cast(SPANS)


def label(items: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(items, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """(row, id, key, base, weak): every row of ``docs`` as a struct, with the sorted spans of
    the base kinds and the weak candidates."""
    t = F.coalesce(F.col("row.text"), F.lit(""))
    base = F.array_sort(F.concat(
        spans(t, "assign", ASSIGN, t.rlike(r"[:=]") & t.rlike("(?i)passw|secret|token|api_?key"), 12, 2),
        spans(t, "access", ACCESS, t.contains("AKIA"), 18),
        spans(t, "hex", HEX, t.rlike(HEX))))
    weak = F.concat(spans(t, "secret", SECRET, t.contains("AKIA") & t.rlike("[A-Za-z0-9+/]{40}")),
                    spans(t, "endpoint", ENDPOINT, t.contains("://")))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row", F.col("row.doc_id").alias("id"), F.xxhash64(t).alias("key"), base.alias("base"), weak.alias("weak"))


def bins(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / SCOPE), F.floor((end - 1) / SCOPE)))


def linked(found: DataFrame) -> DataFrame:
    """(x_id, x_key, extra): weak candidates that meet a scope of a complementary part."""
    rows = found.filter((F.size("weak") > 0) & (F.size("base") > 0)).select("id", "key", "base", "weak")
    weak = (rows.select("id", "key", F.explode("weak").alias("w")).select("id", "key", "w.*").distinct()
            .withColumn("bin", bins(F.col("start"), F.col("end"))))
    scopes = (rows.select("id", "key", F.explode("base").alias("s")).distinct()
              .select("id", "key", (F.col("s.start") - SCOPE).alias("lo"), (F.col("s.end") + SCOPE).alias("hi"), F.col("s.kind").alias("own"))
              .withColumn("bin", bins(F.col("lo"), F.col("hi"))))
    opens = F.lit(False)
    for name, others in COMPLEMENTS.items():
        opens |= (weak["kind"] == KINDS.index(name)) & scopes["own"].isin([KINDS.index(o) for o in others])
    join = [weak["id"].eqNullSafe(scopes["id"]), weak["key"] == scopes["key"], weak["bin"] == scopes["bin"],
            weak["start"] < scopes["hi"], weak["end"] > scopes["lo"], opens]
    met = weak.join(scopes, join, "left_semi").select("id", "key", "start", "kind", "end").distinct()
    return met.groupBy(F.col("id").alias("x_id"), F.col("key").alias("x_key")).agg(
        F.collect_list(F.struct("start", "kind", "end")).cast(SPANS).alias("extra"))


def secret_spans(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """(row, base, all): per row of ``docs`` the base spans and all spans, both sorted. The
    text is left out of ``row`` unless it is asked for."""
    found = scan(docs)
    if not keep_text:
        found = found.withColumn("row", F.struct(F.col("id").alias("doc_id")))
    found = written(found, "secret-scan")
    rows = found.filter(F.size("weak") > 0).join(
        linked(found), F.col("id").eqNullSafe(F.col("x_id")) & (F.col("key") == F.col("x_key")), "left")
    every = F.array_sort(F.concat("base", F.coalesce("extra", F.array().cast(SPANS))))
    met = rows.select("row", "base", every.alias("all"))
    plain = found.filter(F.size("weak") == 0).select("row", "base", F.col("base").alias("all"))
    return plain.unionByName(met)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked) for every row."""
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(kind))).cast("long")
    return secret_spans(docs).select(
        F.col("row.doc_id").alias("doc_id"), n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(label(F.col("base")), 256).alias("base_sha256"), label(F.col("all")).alias("spans"),
        (F.size("all") - F.size("base")).cast("long").alias("n_linked"))


def masked(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span of a text replaced by ``mask`` (overlapping spans by one);
    n_chars, where there is such a column, follows the new text. Other columns stay."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    longs = lambda field: F.transform("all", lambda x: x[field])

    def piece(pages, lo, hi):
        """Code points lo to hi, cut from the pages that hold them."""
        first = F.floor(lo / PAGE).cast("int")
        cut = lambda i: F.substring(
            F.element_at(pages, i + 1), (F.greatest(lo - i * PAGE, F.lit(0)) + 1).cast("int"),
            (F.least(hi - i * PAGE, F.lit(PAGE)) - F.greatest(lo - i * PAGE, F.lit(0))).cast("int"))
        return F.when(hi <= lo, "").otherwise(F.array_join(F.transform(
            F.sequence(first, F.floor((F.greatest(hi, lo + 1) - 1) / PAGE).cast("int")), cut), ""))

    def cleaned(pages):
        # spans are sorted by start: what is kept lies between the furthest end so far and the next start
        ends = before(longs("end"), 0, lambda a, x: F.greatest(a, x))
        kept = F.zip_with("all", ends, lambda x, e: F.when(
            x["start"] >= e, F.concat(piece(pages, e, x["start"]), F.lit(mask))).otherwise(""))
        return F.concat(F.array_join(kept, ""), piece(pages, F.array_max(longs("end")), F.char_length(text).cast("long")))

    clean = let(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % PAGE), F.lit(0)), cleaned)
    hit = F.size("all") > 0
    changed = {"text": F.when(hit, clean).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(hit, F.char_length(clean).cast("long")).otherwise(F.col("row.n_chars"))
    return secret_spans(docs, keep_text=True).select(
        *[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
