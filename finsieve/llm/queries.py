"""The registered queries of the dealt operators, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from finsieve.llm import (
    op01_warc, op02_packing, op03_ctw, op04_substring, op05_simhash, op06_decontaminate, op07_language, op08_quality, op09_line_dedup,
    op10_neighbours, op11_whitening, op12_alignment, op13_secrets,
)
from finsieve.llm.common import held_out, table
from finsieve.session import new_path, stage

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return register


OP1_SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
     q as (select page_id, cast(strlen(h) as bigint) as payload_bytes, sha1(h) as payload_digest from p),
     g as (select payload_digest, max(page_id) as keeper from q where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, payload_digest,
       case when page_id is distinct from keeper and keeper is not null then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from keeper then keeper end as refers_to
from q left join g using (payload_digest)
"""


@query("op1_warc", OP1_SQL)
def _warc(spark, d):
    path = new_path(spark, "warc")
    op01_warc.write(table(spark, d, "pages"), path)
    return op01_warc.payloads(stage(op01_warc.records(spark, path), "records"))


@query("op2_best_fit_packing")
def _packing(spark, d):
    packed = op02_packing.pack_documents(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op3_context_tree")
def _context_tree(spark, d):
    scored = op03_ctw.score(table(spark, d, "documents"), held_out(F.col("doc_id"), 10, 0))
    return scored.withColumnRenamed("id", "doc_id")


@query("op4_collinear_chains")
def _chains(spark, d):
    return op04_substring.passages(table(spark, d, "documents")).withColumnRenamed("id", "doc_id")


@query("op5_simhash")
def _simhash(spark, d):
    found = op05_simhash.near_duplicates(table(spark, d, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.hex("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )


_WORDS6 = "list_filter(regexp_split_to_array(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
OP6_SQL = f"""
with d as (select row_number() over () as r, doc_id, {_WORDS6.format('text')} as w from documents),
     b as (select item_id, {_WORDS6.format('text')} as w from benchmark where text is not null),
     win as (select distinct item_id, least(len(w), 10) as k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as g
             from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
     ks as (select distinct k from win),
     dw as (select r, k, i, array_to_string(w[i:i + k - 1], ' ') as g
            from (select r, w, k, unnest(range(1, len(w) - k + 2)) as i from d, ks where len(w) >= k)),
     hit as (select r, i, dw.k, item_id from dw join win on dw.k = win.k and dw.g = win.g),
     words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + k)) as p from hit) group by r),
     items as (select r, count(*) as n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
               from (select distinct r, item_id from hit) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)
"""


@query("op6_decontaminate", OP6_SQL)
def _decontaminate(spark, d):
    return op06_decontaminate.digest(
        op06_decontaminate.decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark"))
    )


@query("op8_quality")
def _quality(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    known = op08_quality.labelled(
        docs, labels, ~held_out(F.col("doc_id"), 4, 2), "doc_id", "text", "quality", op08_quality.FIT_ROWS
    )
    scored = op08_quality.score(docs, op08_quality.fit(known))
    return scored.select(
        F.col("id").alias("doc_id"), held_out(F.col("id"), 4, 2).alias("held_out"), "score", "predicted"
    )


OP9_SQL = """
with recursive
     d as materialized (select row_number() over () as r, doc_id, text from documents),
     s as (select r, doc_id, unnest(range(len(ls))) as i, unnest(ls) as line
           from (select r, doc_id, string_split(text, chr(10)) as ls from d where text is not null)),
     w as (select *, len(list_filter(regexp_split_to_array(line, '[\t\n\x0B\f\r ]+'), lambda x: x <> '')) as words from s),
     l as materialized (select r, i, line, words, row_number() over o + dense_rank() over (order by doc_id nulls first, r) as g, sum(words) over o as total
           from w where words > 0 window o as (order by doc_id nulls first, r, i)),
     alive(n, g, c) as (
       select 1, g, min(g) over (partition by line) from l qualify count(*) over (partition by line) > 1
       union all
       select n + 1, a.g, min(a.g) over p from alive a join l on l.g = a.g + a.n
       window p as (partition by a.c, l.line) qualify count(*) over p > 1),
     m as (select g, max(n) as n from alive where c < g group by g),
     runs as (select a.g, m.n from m join l a using (g) join l z on z.g = a.g + m.n - 1 where z.total - a.total + a.words >= 5),
     gone as (select distinct l.r, l.i from (select unnest(range(g, g + n)) as g from runs) x join l using (g)),
     kept as (select s.r, string_agg(s.line, chr(10) order by s.i) as left_over from s anti join gone on s.r = gone.r and s.i = gone.i group by s.r),
     k as (select r, count(*) as n_deleted from gone group by r)
select d.doc_id, cast(case when d.text is null then 0 else len(string_split(d.text, chr(10))) end as integer) as n_lines,
       cast(coalesce(n_deleted, 0) as integer) as n_deleted,
       case when d.text is null then null else coalesce(left_over, '') end as text
from d left join k using (r) left join kept using (r)
"""


@query("op9_line_dedup", OP9_SQL)
def _line_dedup(spark, d):
    done = op09_line_dedup.line_dedup(table(spark, d, "documents"))
    return done.select(F.col("id").alias("doc_id"), "n_lines", F.size("deleted").alias("n_deleted"), "text")


@query("op7_language")
def _language(spark, d):
    docs = table(spark, d, "documents")
    known = op07_language.profiles(docs, ~held_out(F.col("doc_id"), 5, 0))
    found = op07_language.identify(docs, known)
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id"), 5, 0).alias("held_out"), "lang_pred", "score")


OP10_SQL = """
with v as (select row_number() over () as r, vec_id, cast(embedding as double[]) as x from embeddings
           where vec_id is not null and embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda e: e is null or isnan(e) or isinf(e))) = 0
             and len(list_filter(embedding, lambda e: e <> 0)) > 0),
     p as (select q.r, q.vec_id as query_id, c.vec_id, c.r as cr,
                  sqrt(list_reduce(list_transform(list_zip(q.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) as score
           from v q join v c on q.r <> c.r and len(q.x) = len(c.x) where q.vec_id % 100 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by r order by score, vec_id, cr) as rank from p) where rank <= 10
"""


@query("op10_neighbours", OP10_SQL)
def _neighbours(spark, d):
    return op10_neighbours.neighbours(table(spark, d, "embeddings"))


@query("op11_whitening")
def _whitening(spark, d):
    rows = op11_whitening.components(op11_whitening.whiten(table(spark, d, "embeddings")))
    return rows.select(
        F.col("id").alias("vec_id"), "component", "n", F.col("deviation").cast("bigint").alias("deviation"), "whitened", "explained",
        "identity_error",
    )


@query("op12_alignment")
def _alignment(spark, d):
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    done = op12_alignment.align(table(spark, d, "documents"), *files, keep_groups=False)
    return done.drop("groups").withColumnRenamed("id", "doc_id")


@query("op13_secrets")
def _secrets(spark, d):
    docs = table(spark, d, "documents")
    return op13_secrets.digest(op13_secrets.scan(docs, op13_secrets.learn(docs))).withColumnRenamed("id", "doc_id")
