"""Registered queries of the training-data operators, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.llm._batches import table
from lakestream.llm._ship import ship
from lakestream.llm.bpe import bpe_encode
from lakestream.llm.decontaminate import benchmark_leaks
from lakestream.llm.filter_audit import filter_audit
from lakestream.llm.language_hd import fit_profiles, predict_language
from lakestream.llm.merkle import merkle_manifest
from lakestream.llm.mixing import MOST, SEED, SHARE, STRATA, WEIGHTS, mix
from lakestream.llm.packing import pack_tokens
from lakestream.llm.probminhash import near_duplicates
from lakestream.llm.quality_crf import fit_crf, quality_rules
from lakestream.llm.suffix_dedup import remove_repeats
from lakestream.llm.token_counts import apply_edits, token_trees
from lakestream.llm.toxicity import fit_ordinal, toxicity
from lakestream.llm.url_rules import ALLOW, CONFIDENCE, RULES, SUPPORT, filter_urls

#: The tokenizer file of op3, a parameter of the operator.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: The rank file of op1 and op5, and the id after each document (one that the file leaves free).
BYTE_RANKS, SEPARATOR = public_tokenizers.path("byte_bpe_50k.tiktoken"), 50256


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN, SEPARATOR)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe_encode(table(spark, sf_dir, "documents"), WORD_BPE, keep_chunks=400_000, slice_bytes=2 << 20)
    return tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                         F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_urls(table(spark, sf_dir, "pages"))
    return found.withColumn("mined", F.array_join("mined", " "))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text before and after three edits: an insert, a deletion and a replacement, placed by a hash of the id."""
    size = F.length(F.coalesce("text", F.lit("")))
    place = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), size + 1).alias("at")
    part = lambda k, at, n: F.substr(F.coalesce("text", F.lit("")), F.lit(at), F.lit(n)).alias("put")
    long = lambda n: F.lit(n).cast("long").alias("cut")
    edits = F.array(F.struct(place(1), long(0), part(1, 1, 40)), F.struct(place(2), long(60), F.lit("").alias("put")),
                    F.struct(place(3), long(25), part(3, 11, 30)))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", edits.alias("edits"))
    counted = apply_edits(token_trees(docs, BYTE_RANKS, public_tokenizers.PATTERN, edits_col="edits"),
                          BYTE_RANKS, public_tokenizers.PATTERN)
    return counted.select("doc_id", F.col("n_tokens_before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_edited"),
                          F.length("text").cast("long").alias("n_chars_edited"), "encoded_chars",
                          F.sha2(F.encode("text", "UTF-8"), 256).alias("edited_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, fit_crf(docs, table(spark, sf_dir, "labels")))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"), "text")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, fit_ordinal(docs, table(spark, sf_dir, "labels")))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn(
        "held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    profiles = fit_profiles(docs.where(~F.col("held_out")))
    found = predict_language(docs, profiles)
    return found.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).alias("held_out"),
                        "lang_pred", "score")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, checked against a copy whose n_chars is one too large in the rows of every seventh id by hash."""
    docs = table(spark, sf_dir, "documents")
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n_chars = F.col("n_chars").cast("decimal(38,0)")
    found = merkle_manifest(docs, checked={"n_chars": F.when(touched, n_chars + 1).otherwise(n_chars)})
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _shipped(query: Callable) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_packing, op2_decontamination, op3_bpe, op4_url_filter, op5_token_counts, op6_quality,
             op7_suffix_dedup, op8_toxicity, op9_near_duplicates, op10_language, op11_merkle, op12_filter_audit, op13_mixing)
    return {q.__name__: _shipped(q) for q in found} | {"pipeline": _shipped(corpus_pipeline.run)}


#: All windows where a document has a shingle of an item, by the counts of their shingles.
_OP2_SQL = r"""
with d as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from documents where text is not null),
b as (select item_id, w, len(w) as n, least(5, len(w)) as k
      from (select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from benchmark where text is not null)
      where len(w) > 0),
bs as (select item_id, n, k, i, array_to_string(w[i:i + k - 1], ' ') as s
       from (select *, unnest(range(1, n - k + 2)) as i from b)),
ds as (select doc_id, len(w) as m, k, i, array_to_string(w[i:i + k - 1], ' ') as s
       from (select d.*, k, unnest(range(1, len(w) - k + 2)) as i from d, (select distinct k from b))),
cand as (select distinct doc_id, item_id, n, bs.k, greatest(0, least(greatest(0, ds.i - bs.i), m - n)) as start
       from ds join bs on ds.s = bs.s and ds.k = bs.k),
win as (select doc_id, item_id, n, start, array_to_string(w[i:i + k - 1], ' ') as s, count(*) as c
        from (select cand.*, d.w[start + 1:start + n] as w,
                unnest(range(1, len(d.w[start + 1:start + n]) - k + 2)) as i from cand join d using (doc_id))
        group by all),
item as (select item_id, s, count(*) as c from bs group by all),
met as (select doc_id, item_id, n, start, sum(win.c) as cw, sum(coalesce(least(win.c, item.c), 0)) as shared
         from win left join item using (item_id, s) group by all),
sim as (select doc_id, item_id, start, n, shared / (cw + total - shared) as similarity
        from met join (select item_id, sum(c) as total from item group by all) using (item_id))
select doc_id, item_id, cast(start as integer) as start_word, cast(n as integer) as n_words,
  cast(similarity as double) as similarity
from sim where similarity >= 0.8
qualify row_number() over (partition by doc_id, item_id order by similarity desc, start) = 1"""

#: All combinations of the tokens of the URLs that a listed rule fits, counted.
_OP4_SQL = rf"""
with p as (select page_id, coalesce(substr(url, nullif(position('://' in url), 0) + 3), '') as rest from pages),
h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) as query from p),
r as (select rule, verdict, split_part(rule, '/', 1) as own, substr(rule, position('/' in rule)) as start
      from (values {", ".join(map(str, RULES))}) as v(rule, verdict)),
l as (select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
      from h join r on (host = own or suffix(host, '.' || own)) and starts_with(path, start) group by page_id),
s as (select page_id, list_filter(string_split(host, '.'), lambda x: x <> '') as labels, path, query from h),
t as (select page_id, list_sort(list_distinct(list_concat(
          list_transform(range(1, len(labels) + 1), lambda i: 'host:' || array_to_string(labels[i:], '.')),
          list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'path:' || regexp_replace(x, '[0-9]+', '0', 'g')),
          list_transform(list_filter(string_split(query, '&'), lambda x: x <> ''), lambda x: 'query:' || split_part(x, '=', 1))))) as tokens
      from s),
part as (select verdict, list_filter(tokens, lambda x, i: (m >> (i - 1)) & 1 = 1) as part
         from (select tokens, verdict, unnest(range(1, 1 << len(tokens))) as m from t join l using (page_id))),
n as (select count(*) as n from l),
c as (select part, verdict, c / sum(c) over (partition by part) as confidence, c / n as support, c, n
      from (select part, verdict, count(*) as c from part group by all), n),
found as (select * from c where c >= ceil({SUPPORT} * n) and confidence >= {CONFIDENCE}),
kept as (select * from found a where not exists (select 1 from found b where b.verdict = a.verdict
           and b.confidence >= a.confidence and len(b.part) < len(a.part) and list_has_all(a.part, b.part))),
best as (select page_id, k.verdict, array_to_string(part, ' ') as mined
         from (select * from t where page_id not in (select page_id from l)) t join kept k on list_has_all(t.tokens, k.part)
         qualify row_number() over (partition by page_id
           order by confidence desc, support desc, len(part) desc, k.verdict desc, part desc) = 1)
select page_id, host, path, rule, coalesce(l.verdict, best.verdict, '{ALLOW}') as verdict, mined
from h left join l using (page_id) left join best using (page_id)"""

#: Every 400-byte string, counted; bytes as pairs of hexadecimal digits. The text left has the whole characters among them.
_OP7_SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents),
w as (select doc_id, i, md5(substr(h, 2 * i + 1, 800)) as m from (select *, unnest(range(0, n - 399)) as i from d)),
dup as (select doc_id, i from w where m in (select m from w group by m having count(*) > 1)),
run as (select *, sum(fresh) over (partition by doc_id order by i) as g
        from (select *, case when i <= lag(i) over (partition by doc_id order by i) + 400 then 0 else 1 end as fresh from dup)),
span as (select doc_id, g, min(i) as a, max(i) + 400 as z from run group by all),
cut as (select *, coalesce(lag(z) over (partition by doc_id order by a), 0) as before from span),
part as (select doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as head,
           max(z) as z, sum(z - a) as removed, count(*) as spans from cut join d using (doc_id) group by all),
kept as (select *, coalesce(head, '') || substr(h, 2 * coalesce(z, 0) + 1) as left_over from d left join part using (doc_id))
select doc_id, n as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed, coalesce(spans, 0) as n_spans,
  sha256(unhex(left_over)) as kept_sha256,
  decode(unhex(case when removed is null then left_over else array_to_string(list_filter(regexp_extract_all(left_over,
    '[0-7].|(?:C[2-9A-F]|D.)[89AB].|E0[AB].[89AB].|E[1-9ABCEF](?:[89AB].){2}|ED[89].[89AB].|F0[9AB].(?:[89AB].){2}|F[1-3](?:[89AB].){3}|F48.(?:[89AB].){2}|..'),
    lambda x: length(x) > 2 or x < '8'), '') end)) as text
from kept"""


_FIELD = "coalesce(octet_length(encode({0}::varchar)) || ':' || {0}::varchar, '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
_CLAIM = _LEAF.replace("n_chars", "(n_chars + 1)")

#: Levels of all trees by recursion, then each leaf's way up by recursion. crc32 by its bits.
_OP11_SQL = f"""
with recursive
crc(doc_id, s, i, c) as (
  select doc_id, doc_id::varchar, 0, 4294967295::bigint from (select distinct doc_id from documents where doc_id is not null)
  union all select doc_id, s, i + 1, list_reduce(
      [xor(c, ascii(s[i + 1])::bigint), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) from crc where i < length(s)),
leaf as (select doc_id, coalesce('=' || lang, '') as tree, sha256({_LEAF}) as leaf,
           case when xor(c, 4294967295) % 7 = 0 and n_chars is not null then sha256({_CLAIM}) else sha256({_LEAF}) end as claim
         from documents left join (select * from crc where i = length(s)) using (doc_id)),
n0 as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf, claim) - 1 as pos,
         count(*) over (partition by tree) as n from leaf),
up(tree, level, pos, n, digest) as (
  select tree, 0, pos, n, leaf from n0
  union all select tree, level + 1, pos // 2, max((n + 1) // 2), sha256(string_agg(digest, '' order by pos))
  from up where n > 1 group by tree, level, pos // 2),
top as (select tree, level as depth, digest as subroot, row_number() over (order by tree) - 1 as place, count(*) over () as trees
        from up where n = 1),
up2(level, pos, n, digest) as (
  select 0, place, trees, subroot from top
  union all select level + 1, pos // 2, max((n + 1) // 2), sha256(string_agg(digest, '' order by pos))
  from up2 where n > 1 group by level, pos // 2),
root as (select level as height, digest as root from up2 where n = 1),
nodes as (select tree, level, pos, digest from up where n > 1 union all select '/' || tree, level, pos, digest
          from (select level, pos, digest from up2 where n > 1), (select tree from top)),
f(row, tree, pos, level, d, sibs, first, depth) as (
  select row_number() over (), tree, pos, 0, claim, '', leaf, depth from n0 join top using (tree)
  union all select f.row, f.tree, f.pos // 2, f.level + 1,
    sha256(case when s.digest is null then f.d when f.pos % 2 = 0 then f.d || s.digest else s.digest || f.d end),
    f.sibs || coalesce(s.digest, ''), f.first, f.depth
  from f left join nodes s on s.tree = f.tree and s.level = f.level and s.pos = xor(f.pos, 1) where f.level < f.depth),
g(row, tree, pos, level, d, sibs) as (
  select f.row, tree, place, 0, d, sibs from f join top using (tree) where level = f.depth
  union all select g.row, g.tree, g.pos // 2, g.level + 1,
    sha256(case when s.digest is null then g.d when g.pos % 2 = 0 then g.d || s.digest else s.digest || g.d end),
    g.sibs || coalesce(s.digest, '')
  from g left join nodes s on s.tree = '/' || g.tree and s.level = g.level and s.pos = xor(g.pos, 1)
  where g.level < (select height from root)),
ids as (select row_number() over () as row, doc_id, tree, leaf from n0 join top using (tree))
select doc_id, leaf, subroot, root, sha256(sibs) as proof_sha256, d as folded_root, d = root as verified
from g join ids using (row) join top on top.tree = g.tree, root where g.level = height"""

#: Each document's filters as bits, counted; every order and step sums up the bits that it asks for.
_OP12_SQL = r"""
with recursive
t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from t),
m as (select part, doc_id in (select doc_id from labels where quality = 1) as good,
        doc_id in (select doc_id from labels where toxic = 1) as toxic,
        (len(w) < 50)::int + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::int
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::int
        + 8 * regexp_matches(text, '[#$%&*|]')::int
        + 16 * coalesce(doc_id > min(doc_id) over (partition by text), false)::int as m from w),
c as (select part, m, count(*) as n, count(*) filter (good) as g, count(*) filter (toxic) as x from m group by all),
o(s, used) as (select '', 0 union all select s || chr(65 + i::int), used | (1 << i::int) from o, range(5) as r(i) where (used >> i::int) & 1 = 0),
p as (select s as filter_order, step::int as step, ascii(s[step]) - 65 as f,
        coalesce(list_sum(list_transform(range(1, step), lambda j: 1 << (ascii(s[j]) - 65))), 0)::int as before
      from (select s, unnest(range(1, 6)) as step from o where length(s) = 5)),
a as (select part, filter_order, step, f,
        sum(n) filter (m & (before | (1 << f)) = 0) as kept, sum(n) filter (m & before = 0 and (m >> f) & 1 = 1) as removed,
        sum(n) filter (m & before <> 0 and (m >> f) & 1 = 1) as redundant, sum(n) filter (m = 1 << f) as unique_fails,
        sum(g) filter (m & before = 0 and (m >> f) & 1 = 1) as good_lost, sum(x) filter (m & before = 0 and (m >> f) & 1 = 1) as toxic_lost
      from c, p group by all)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
  coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
  coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  coalesce(sum(removed) over (partition by part, f), 0)::bigint as shapley
from a"""


def _op13_sql() -> str:
    cases = " ".join(f"when {i} then {w}" for i, w in enumerate(WEIGHTS))
    take = "goal > 0 and 2 * before + size <= 2 * goal"
    goal = "words * case when words_left > 0 then least(1.0::double, greatest(0.0::double, need / words_left)) else 0.0 end"
    rounds = ""
    for k in range(len(STRATA) + 1):
        left = "select source, rest as need, source_size::double as words_left from s" if k == 0 else f"""
  select l.source, l.need - coalesce(took, 0) as need, l.words_left - l.words as words_left from g{k - 1} l left join (
    select source, sum(size) as took from r join g{k - 1} using (source) where stratum = {k - 1} and {take} group by source) using (source)"""
        rounds += f""",
g{k} as (select *, {goal} as goal from (select l.*, coalesce(words, 0)::double as words from ({left}) l
  left join (select source, sum(size) as words from r where stratum = {k} group by source) using (source)))"""
    return f"""
with recursive
d as (select doc_id, coalesce('=' || source, '') as source, source as own,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
        md5('{SEED}:' || coalesce(doc_id::varchar, '-') || ':' || md5(coalesce(text, ''))) as draw from documents),
b as (select source, any_value(own) as own, sum(size)::bigint as source_size from d group by source),
w as (select source, source_size, case (row_number() over (order by own nulls last) - 1) % {len(WEIGHTS)} {cases} end::double as weight from b),
v(i, level) as (
  select 0, {SHARE} * sum(source_size) / sum(weight) from w
  union all select i + 1, ({SHARE} * (select sum(source_size) from w)
      - (select coalesce(sum(source_size * {MOST}), 0) from w where source_size * {MOST} <= level * weight))
      / (select sum(weight) from w where source_size * {MOST} > level * weight)
  from v where i < 100 and exists (select 1 from w where source_size * {MOST} > level * weight)),
t as (select source, source_size, least((source_size * {MOST})::double, (select max(level) from v) * weight) as target from w),
s as (select *, target - whole * source_size as rest
      from (select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as whole from t)),
r as (select *, sum(size) over (partition by source, stratum order by draw, doc_id rows unbounded preceding) - size as before
      from (select d.*, source_size, target, whole, rest, {" + ".join(f"(size <= rest * {float(x)!r}::double)::int" for x in STRATA)} as stratum
            from d join s using (source))){rounds},
g as ({" union all ".join(f"select source, {k} as stratum, goal from g{k}" for k in range(len(STRATA) + 1))})
select doc_id, size::bigint as size, source_size, target, ((whole + ({take})::int) * size)::bigint as taken
from r join g using (source, stratum)"""


def oracle_sql() -> dict[str, str]:
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {"op2_decontamination": _OP2_SQL, "op4_url_filter": _OP4_SQL, "op7_suffix_dedup": _OP7_SQL,
            "op11_merkle": _OP11_SQL, "op12_filter_audit": _OP12_SQL, "op13_mixing": _op13_sql()} | own
