"""Queries of cleaning, page tests, chunking and normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import extract, retrieve
from .catalog import load, query

CLEAN_SQL = r"""regexp_replace(regexp_replace({0}, '([\p{{L}}\p{{N}}_]+)-\n([\p{{L}}\p{{N}}_]+)', '\1\2', 'g'),
  '[\s\x0b\x1c-\x1f\x85\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g')"""
CHUNK_SQL = (
    "with recursive c as (select doc_id, "
    + CLEAN_SQL.format("text")
    + r""" t from documents where text <> ''),
s as (select doc_id, t, list_concat(case when t[1] <> ' ' then [0] else []::bigint[] end,
        list_filter(range(0, length(t)), lambda i: t[i+1] = ' ')) st from c),
p as materialized (select doc_id, st, list_concat(st[2:], [length(t)]) en from s where len(st) > 0),
r as (select doc_id, 0 idx, 1 i, st, en, len(list_filter(en, lambda x: x <= st[1] + 4096)) e from p
      union all
      select doc_id, idx + 1, j, st, en, len(list_filter(en, lambda x: x <= st[j] + 4096)) from (
        select *, len(list_filter(st[1:e], lambda x: en[e] - x > 500
               or en[e] - x + (en[e+1] - st[e+1]) > 4096)) + 1 j from r where e < len(st))),
chunks as (select r.doc_id, cast(idx as int) chunk_index, trim(substring(t, st[i] + 1, en[e] - st[i])) chunk from r join c using (doc_id))
"""
)
MARKERS_SQL = r"(?:^|\n)(?:Appendix ?[^\s]*[\n:]|Acknowledgements[.]|Author contributions[.]|References\s*\n|[0-9]?\s?(?:Data|Code|Code and data) availability)"
ABSTRACT_SQL = r"(?:^|\n)Abstract[:.]?\s?"
TAILS = ("'\n\nReferences\nA'", "'\nAppendix A:\nx'", "'\nAcknowledgements. We'", "''")


def _tail_sql(newline: str) -> str:
    cases = " ".join(f"when {i} then {t}" for i, t in enumerate(TAILS)).replace("\n", newline)
    return f"case doc_id % 4 {cases} end"


@query("select doc_id, " + CLEAN_SQL.format(r"replace(text, 'e ', 'e-' || chr(10))") + " cleaned from documents")
def clean_text(spark, sf_dir):
    """F6, F7 on texts into which words cut at line ends were put."""
    return load(spark, sf_dir, "documents").select("doc_id", T.clean(F.replace(F.col("text"), F.lit("e "), F.lit("e-\n"))).alias("cleaned"))


@query(CHUNK_SQL + "select * from chunks")
def chunk_documents(spark, sf_dir):
    return retrieve.chunked(load(spark, sf_dir, "documents"))


@query(CHUNK_SQL + "select doc_id, count(*) n_chunks, max(length(chunk)) longest, sum(length(chunk))::bigint total from chunks group by doc_id")
def chunk_stats(spark, sf_dir):
    size = F.length("chunk").cast("long")
    return retrieve.chunked(load(spark, sf_dir, "documents")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"), F.max(size).alias("longest"), F.sum(size).alias("total"))


@query("select doc_id, length(text)::bigint n from documents where text <> ''")
def nonempty_text(spark, sf_dir):
    return load(spark, sf_dir, "documents").where("text <> ''").select("doc_id", F.length("text").cast("long").alias("n"))


@query("select doc_id, len(string_split(text, chr(10))) <= 12 sparse from documents")
def sparse_page(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", T.is_sparse_page(F.col("text")).alias("sparse"))


@query("select doc_id, replace(replace(replace(text, 'th', 'ﬂ') || 'ﬁt', 'ﬂ', 'fl'), 'ﬁ', 'fi') fixed from documents")
def ligature_fix(spark, sf_dir):
    text = F.concat(F.replace(F.col("text"), F.lit("th"), F.lit("ﬂ")), F.lit("ﬁt"))
    return load(spark, sf_dir, "documents").select("doc_id", T.without_ligatures(text).alias("fixed"))


@query(f"""
with d as (select doc_id, text || {_tail_sql("' || chr(10) || '")} text from documents)
select doc_id, case when regexp_matches(text, '{MARKERS_SQL}') then regexp_extract(text, '(?s)^(.*?)(?:{MARKERS_SQL})', 1) end kept from d
""")
def end_marker_cut(spark, sf_dir):
    tails = F.element_at(F.array(*[F.lit(t.strip("'")) for t in TAILS]), (F.col("doc_id") % 4 + 1).cast("int"))
    return load(spark, sf_dir, "documents").select("doc_id", T.before_end_marker(F.concat("text", tails)).alias("kept"))


@query(rf"""
with d as (select doc_id, case when doc_id % 2 = 0 then 'Title' || chr(10) || 'Abstract. ' || text else text end text from documents)
select doc_id, case when regexp_matches(text, '{ABSTRACT_SQL}') then regexp_extract(text, '(?s){ABSTRACT_SQL}(.*)', 1) end body from d
""")
def abstract_start(spark, sf_dir):
    text = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Title\nAbstract. "), F.col("text"))).otherwise(F.col("text"))
    return load(spark, sf_dir, "documents").select("doc_id", T.after_abstract(text).alias("body"))


@query("""
with s as (select vec_id, list_transform(embedding, lambda x: x::double * (vec_id + 1)) v from embeddings),
n as (select vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) norm from s)
select vec_id, round(v[1] / norm, 6) first, round(v[64] / norm, 6) last, round(list_sum(list_transform(v, lambda x: x / norm * x / norm)), 6) square from n
""")
def l2_normalize(spark, sf_dir):
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") + 1))
    v = load(spark, sf_dir, "embeddings").select("vec_id", T.l2_normalized(scaled).alias("v"))
    return v.select("vec_id", F.round(F.get("v", F.lit(0)), 6).alias("first"), F.round(F.get("v", F.lit(63)), 6).alias("last"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x), 6).alias("square"))


AUTOMATON_SQL = rf"""
with d as (
  select doc_id, string_split('Title' || chr(10) || 'Abstract. ' || replace(text, '. ', '.' || chr(10)) || chr(10) || array_to_string(['Table 1. Values', '1 2', '3 4', '5 6', '7 8', 'References', 'A'], chr(10)), chr(10)) lines from documents),
p as (select doc_id, unnest(range(0, (len(lines) - 1) // 40 + 1)) k, lines from d),
g as (select doc_id, k, array_to_string(lines[k * 40 + 1:k * 40 + 40], chr(10)) page from p),
c as (select *, regexp_matches(page, '(?:^|\n)Table [0-9A-Za-z_]?[0-9]+[.]') captioned, regexp_extract(page, '(?s)^(.*?)(?:^|\n)Table [0-9A-Za-z_]?[0-9]+[.]', 1) before from g),
l as (select *, case when captioned then string_split(substring(page, length(before) + 1), chr(10)) else [] end ls from c),
w as (select *, list_transform(ls, lambda x: len(regexp_split_to_array(x, ' |-|–'))) n from l),
h as (select *, coalesce(list_filter(n, lambda x: x > 1)[1], 0) header from w),
t as (
  select *, list_transform(range(1, len(ls) + 1), lambda i: case when n[i] < (case when header = 0 then 8 when header >= 15 then 9 else 7 end) then 's'
    when header >= 15 and n[i] > 20 and not regexp_matches(ls[i], '^Table [0-9A-Za-z_]?[0-9]+[.]') then '-' else 'l' end) kinds from h),
s as (
  select *, list_reduce(list_transform(range(1, len(kinds) + 1), lambda i: {{'i': i::bigint, 'kind': kinds[i], 'pile': 0::bigint, 'shorts': 0::bigint, 'gave': false, 'last': 0::bigint}}),
    lambda a, x: {{'i': x.i, 'kind': x.kind,
      'pile': greatest(0, a.pile + case x.kind when 'l' then 1 when 's' then -1 else 0 end), 'shorts': a.shorts + (x.kind = 's')::bigint,
      'gave': a.gave or (x.kind = 'l' and a.shorts < 3 and a.pile + 1 = case when header >= 15 then 6 else 10 end),
      'last': case when a.last = 0 and x.kind = 'l' and a.shorts >= 3 and a.pile + 1 = 3 then x.i else a.last end}},
    {{'i': 0::bigint, 'kind': '', 'pile': 0::bigint, 'shorts': 0::bigint, 'gave': false, 'last': 0::bigint}}) z from t),
e as (select *, case when z.last > 0 then z.last else len(ls) end upto, captioned and z.shorts >= 3 and not z.gave found from s),
r as (
  select *, case when len(list_filter(range(upto + 1, len(ls) + 1), lambda i: n[i] > 20)) > 0 then []
    else list_filter(range(coalesce(list_max(list_filter(range(1, upto + 1), lambda i: kinds[i] = 's')), 0) + 1, upto + 1), lambda i: kinds[i] = 'l') end held from e),
q as (
  select doc_id, k, page, case when not captioned then ''
    when found then before || chr(10) || array_to_string(list_transform(held, lambda i: ls[i]), chr(10)) || chr(10) || array_to_string(list_transform(list_filter(range(upto + 1, len(ls) + 1), lambda i: n[i] <= 20), lambda i: ls[i] || chr(10)), '')
    else substring(page, length(before) + 6) end stripped from r),
f as (
  select doc_id, list_reduce(list({{'page': page, 'stripped': stripped, 'acc': '', 'seen': false, 'done': false}} order by k),
    lambda a, x: case when a.done then a
      when not a.seen then (case when regexp_matches(x.page, '{ABSTRACT_SQL}') then {{'page': '', 'stripped': '', 'acc': regexp_extract(x.page, '(?s){ABSTRACT_SQL}(.*)', 1), 'seen': true, 'done': false}} else a end)
      when len(string_split(x.page, chr(10))) <= 12 then a
      when x.stripped <> '' then (case when regexp_matches(a.acc || x.stripped || chr(10), '{MARKERS_SQL}')
        then {{'page': '', 'stripped': '', 'acc': regexp_extract(a.acc || x.stripped || chr(10), '(?s)^(.*?){MARKERS_SQL}', 1), 'seen': true, 'done': true}}
        else {{'page': '', 'stripped': '', 'acc': a.acc || x.stripped || chr(10), 'seen': true, 'done': false}} end)
      when regexp_matches(x.page, '{MARKERS_SQL}') then {{'page': '', 'stripped': '', 'acc': a.acc || regexp_extract(x.page, '(?s)^(.*?){MARKERS_SQL}', 1), 'seen': true, 'done': true}}
      else {{'page': '', 'stripped': '', 'acc': a.acc || x.page || chr(10), 'seen': true, 'done': false}} end,
    {{'page': '', 'stripped': '', 'acc': '', 'seen': false, 'done': false}}) z from q group by doc_id)
select doc_id, length(replace(replace(z.acc, 'ﬂ', 'fl'), 'ﬁ', 'fi'))::bigint n_chars, md5(replace(replace(z.acc, 'ﬂ', 'fl'), 'ﬁ', 'fi')) text_md5 from f
"""


@query(AUTOMATON_SQL)
def page_automaton(spark, sf_dir):
    """G7, F13 to F15 on documents as pages of 40 lines, with an abstract heading and a table put in; the SQL has the same folds."""
    docs = load(spark, sf_dir, "documents")
    lines = docs.select("doc_id", F.split(F.concat(F.lit("Title\nAbstract. "), F.regexp_replace("text", r"\. ", ".\n"), F.lit("\nTable 1. Values\n1 2\n3 4\n5 6\n7 8\nReferences\nA")), "\n").alias("lines"))
    number = F.sequence(F.lit(0), F.floor((F.size("lines") - 1) / 40).cast("int"))
    pages = lines.select("doc_id", F.transform(number, lambda k: F.array_join(F.slice("lines", k * 40 + 1, F.lit(40)), "\n")).alias("pages"))
    found = extract.with_document_text(pages, "pages")
    return found.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))
