"""The registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import functions as F

from tabkit.llm import (decontaminate, minhash, packing, pii, prefix_trie, quality, secrets, sharding, spelling,
                        substrings, suffix_dedup, topk_search, url_filter)
from tabkit.llm.common import parquet, ship_package

#: Path of the vocabulary that documents are packed with.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

# The rules that urls are judged by.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


QUERIES = {}


def registered(f):
    @wraps(f)
    def run(spark, sf_dir):
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@registered
def op1_topk_search(spark, sf_dir):
    rows = topk_search.integer_vectors(parquet(spark, sf_dir, "embeddings"))
    return topk_search.top_k(rows, rows.filter(F.col("id") % 50 == 0), 5)


@registered
def op2_sharding(spark, sf_dir):
    return sharding.shard_rows(parquet(spark, sf_dir, "documents"), 40)


@registered
def op3_quality(spark, sf_dir):
    return quality.scores(parquet(spark, sf_dir, "documents"), parquet(spark, sf_dir, "labels"))


@registered
def op4_secret_scan(spark, sf_dir):
    return secrets.report(parquet(spark, sf_dir, "documents"))


@registered
def op5_minhash(spark, sf_dir):
    return minhash.near_groups(parquet(spark, sf_dir, "documents"))


@registered
def op6_phrase_dedup(spark, sf_dir):
    return substrings.drop_repeats(parquet(spark, sf_dir, "documents"))


@registered
def op7_decontaminate(spark, sf_dir):
    return decontaminate.report(parquet(spark, sf_dir, "documents"), parquet(spark, sf_dir, "benchmark"))


@registered
def op8_packing(spark, sf_dir):
    return packing.pack_documents(parquet(spark, sf_dir, "documents"), VOCABULARY)


@registered
def op9_url_filter(spark, sf_dir):
    return url_filter.judge(parquet(spark, sf_dir, "pages"), URL_RULES)


@registered
def op10_suffix_dedup(spark, sf_dir):
    return suffix_dedup.drop_substrings(parquet(spark, sf_dir, "documents"))


# Fixed values of the word table: which occurrences lose a code point, what counts as a word.
DELETE_EVERY, WORD_LENGTH, WORD_COUNT, FORM_RATIO = 31, 7, 2, 10


def occurrences(docs):
    """(word): every run of letters; where DELETE_EVERY divides the CRC-32 of ``doc_id:run``, the
    code point that the CRC-32 picks is left out."""
    runs = spelling.runs(docs, WORD_LENGTH)
    size = F.char_length("run")
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run"))
    at = (h % size).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, size))
    return runs.select(F.when(h % DELETE_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))


@registered
def op11_spelling(spark, sf_dir):
    words = spelling.count_words(occurrences(parquet(spark, sf_dir, "documents")), WORD_LENGTH, WORD_COUNT)
    return spelling.variants(words, FORM_RATIO)


@registered
def op12_pii(spark, sf_dir):
    return pii.report(parquet(spark, sf_dir, "documents"))


def rebuilt(turns):
    """(conv_id, seq): the first h turns of conversation c - c % 5, then c's own after its first h."""
    own = prefix_trie.conversations(turns)
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string")) % 9).cast("int")
    bases = own.select(c.alias("base"), F.slice("seq", 1, 8).alias("lead"))  # h is at most 8
    joined = own.withColumn("base", c - c % 5).withColumn("h", h).join(bases, "base", "left")
    none = F.array().cast(prefix_trie.TURNS)
    return joined.select("conv_id", F.concat(
        F.coalesce(F.slice("lead", F.lit(1), F.col("h")), none),
        F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq"), F.lit(1)))).alias("seq"))


@registered
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(rebuilt(parquet(spark, sf_dir, "conversations")))


#: DuckDB: CRC-32 of a list of bytes, by its definition.
CRC32_SQL = """xor(list_reduce({bytes}, lambda h, b: list_reduce(range(8), lambda x, k:
    case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end, xor(h, b)), 4294967295::bigint), 4294967295::bigint)"""
A_TO_Z = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: DuckDB: UTF-8 bytes of text whose code points are below U+0100.
LATIN_BYTES = "flatten(list_transform(string_split({}, ''), lambda c: case when ord(c) < 128 then [ord(c)::bigint] else [(192 + (ord(c) >> 6))::bigint, (128 + (ord(c) & 63))::bigint] end))"

ORACLE = {
    "op1_topk_search": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as vec from embeddings
                   where embedding is not null and len(embedding) > 0
                     and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select q.vec_id as query_id, v.vec_id, list_dot_product(q.vec, v.vec)::bigint as score
              from v q join v on v.vec_id <> q.vec_id and len(v.vec) = len(q.vec) where q.vec_id % 50 = 0)
        select query_id, cast(rank as int) as rank, vec_id, score from (
            select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
        where rank <= 5""",
    "op5_minhash": r"""
        with recursive w as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') as ws from documents),
        spot as (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from w where len(ws) > 0),
        s as (select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as shingle from spot),
        n as (select doc_id, count(*) as n from s group by doc_id),
        c as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
        l as (select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 75 * (p.n + q.n - c)),
        e as (select x, y from l union all select y, x from l),
        r as (select doc_id, doc_id as reached from w union select r.doc_id, e.y from r join e on e.x = r.reached)
        select w.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(reached) as component_id, w.doc_id = min(reached) as kept
        from w join r using (doc_id) left join n using (doc_id) group by w.doc_id""",
    "op6_phrase_dedup": r"""
        with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
        spot as (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from w where len(ws) >= 13),
        k as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') as phrase from spot),
        lowest as (select phrase, min(doc_id) as lo from k group by phrase),
        gone as (select distinct doc_id, i + j.range as pos from k join lowest using (phrase) cross join range(13) j where lo < doc_id),
        each as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as pos from w),
        kept as (select doc_id, string_agg(word, ' ' order by pos) as text, count(*) as n from each anti join gone using (doc_id, pos) group by doc_id)
        select w.doc_id, cast(len(ws) as bigint) as n_words, len(ws) - coalesce(kept.n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
        from w left join kept using (doc_id)""",
    "op9_url_filter": r"""
        with r(rule, verdict) as (values ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'),
                                         ('com/fr/', 'allow'), ('com/de/', 'block')),
        p as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
        u as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from p),
        m as (select page_id, max_by(rule, length(rule)) as rule, max_by(verdict, length(rule)) as verdict from u join r
              on (host = split_part(rule, '/', 1) or ends_with(host, '.' || split_part(rule, '/', 1)))
             and starts_with(path, substr(rule, strpos(rule, '/'))) group by page_id)
        select u.page_id, host, path, m.rule, coalesce(m.verdict, 'allow') as verdict from u left join m using (page_id)""",
    "op11_spelling": rf"""
        with recursive r as (select doc_id, unnest(regexp_extract_all({A_TO_Z.format("coalesce(text, '')")}, '[a-zÀ-ÿ]+')) as run from documents),
        o as (select run, {CRC32_SQL.format(bytes=LATIN_BYTES.format("coalesce(doc_id::varchar, '') || ':' || run"))} as h from r where length(run) >= 7),
        w as (select case when h % 31 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from o),
        v as (select word, count(*) as n from w where length(word) >= 7 group by word having count(*) >= 2),
        spot as (select word, unnest(range(1, length(word) + 1)) as i from v),
        less as (select word, i, left(word, i - 1) as x, substr(word, i + 1) as y from spot),
        pair as (select a.word as a, b.word as b from less a join less b on a.x = b.x and a.y = b.y and a.word <> b.word
                 union select l.word, v.word from less l join v on v.word = l.x || l.y
                 union select v.word, l.word from less l join v on v.word = l.x || l.y),
        near as (select a as word, count(*) as n_near, arg_max(v.word, (v.n, -rank)) as best, max(v.n) as best_n
                 from pair join (select *, row_number() over (order by word) as rank from v) v on v.word = b group by a),
        f as (select v.word, case when best_n >= 10 * n then best end as form, v.n, coalesce(n_near, 0) as n_near, case when best_n >= 10 * n then best_n end as form_n
              from v left join near using (word)),
        walk as (select word, word as at from f union all select walk.word, f.form from walk join f on f.word = walk.at where f.form is not null),
        last as (select walk.word, walk.at as root from walk join f on f.word = walk.at where f.form is null)
        select f.word, form, root, n, n_near, form_n from f join last using (word)""",
    "op13_prefix_trie": rf"""
        with own as (select conv_id, list((coalesce(role, ''), coalesce(text, '')) order by turn nulls first) as turns from conversations
                     where conv_id is not null group by conv_id),
        k as (select *, {CRC32_SQL.format(bytes=LATIN_BYTES.format("conv_id::varchar"))} % 9 as h from own),
        c as (select k.conv_id, list_concat(coalesce(b.turns[1:k.h], []), k.turns[k.h + 1:]) as seq
              from k left join own b on b.conv_id = k.conv_id - k.conv_id % 5),
        p as (select conv_id, unnest(range(len(seq) + 1)) as depth, seq from c),
        node as (select depth, seq[1:depth] as pre, min(conv_id) as conv_id, count(*) as n_convs,
                        string_agg(case when len(seq) = depth then conv_id::varchar end, ',' order by conv_id) as ends from p group by all),
        kids as (select depth - 1 as depth, pre[1:depth - 1] as pre, count(*) as n_children from node where depth > 0 group by all),
        full_node as (select node.*, coalesce(n_children, 0) as n_children,
                        case when node.depth > 0 then (n_convs - 1) * strlen(node.pre[node.depth][2]) else 0 end as saved
                      from node left join kids on kids.depth = node.depth and kids.pre = node.pre),
        below as (select unnest(range(depth + 1)) as depth, pre, n_children, saved from full_node),
        total as (select depth, pre[1:depth] as pre, count(*) filter (n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens from below group by all)
        select f.conv_id, f.depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, t.n_leaves, t.saved_tokens, sha256(coalesce(f.ends, '')) as ends_sha256
        from full_node f join total t on t.depth = f.depth and t.pre = f.pre left join node u on f.depth > 0 and u.depth = f.depth - 1 and u.pre = f.pre[1:f.depth - 1]""",
}
