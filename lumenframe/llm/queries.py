"""The operators applied to the driver tables, each next to its DuckDB twin if there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import ship_package, table
from . import ann, audit, bpe, chat, decontam, langid, linededup, lm, mixing, negatives, quality, simhash, warc
from .common import held_out, remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a quarter of them is held out from learning."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, learn_from=remainder(F.col("doc_id"), 4) != 2)
    found = langid.identify(docs, model, ["doc_id"])
    return found.select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


@query
def op2_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, expected and drawn copies of every document under the standard mix."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    found = mixing.mixed(docs)
    return found.select("doc_id", "n_words", F.round("rate", 4).alias("rate"), "copies")


def _mix_sql(rounds: int = 60) -> str:
    """The fit unrolled: one statement per step of a round."""
    dims = (("s", 0.5), ("l", 0.7), ("t", 1.0))
    parts = [r"""d as (select doc_id, coalesce('=' || source, '-') as s, coalesce('=' || lang, '-') as l, n,
        case when n = 0 then 'empty' when 10 * (length(text) - length(replace(text, '|', ''))) >= n then 'table'
             when 10 * (length(text) - length(replace(text, '!', ''))) >= n then 'shout' when n >= 400 then 'long' else 'short' end as t
        from (select *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as n from documents))""",
        "w0 as materialized (select s, l, t, sum(n) as b, cast(sum(n) as double) / (select sum(n) from d) as w from d where n > 0 group by s, l, t)"]
    for name, power in dims:
        parts.append(f"g_{name} as materialized (select {name}, p / sum(p) over () as share from (select {name}, pow(cast(sum(b) as double), {power}) as p from w0 group by {name}))")
    step = 0
    for _ in range(rounds):
        for name, _ in dims:
            step += 1
            parts.append(
                f"w{step} as materialized (select s, l, t, b, w * share / sum(w) over (partition by {name}) as w from w{step - 1} join g_{name} using ({name}))"
            )
    rate = "coalesce(w * (select sum(b) from w0) / b, 0)"
    return "with " + ",\n".join(parts) + f"""
select doc_id, n as n_words, round(rate, 4) as rate,
       cast(floor(rate) + case when u < rate - floor(rate) then 1 else 0 end as bigint) as copies
from (select doc_id, n, {rate} as rate,
             cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null')), 1, 13) as bigint) / 4503599627370496.0 as u
      from d left join w{step} using (s, l, t))"""


ORACLE["op2_mix_to_targets"] = _mix_sql(12)


@query
def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every fiftieth one."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op4_chat_maximal_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered, with length and digest of each part."""
    _, turns = chat.collapse(table(spark, sf_dir, "conversations"))
    return chat.render(turns).select(
        "conv_id", "part", "n_turns", F.octet_length("rendered").cast("bigint").alias("n_bytes"), F.sha2("rendered", 256).alias("rendered_sha256")
    )


ORACLE["op4_chat_maximal_conversations"] = r"""
with t as (select distinct conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text from conversations),
n as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as k,
             count(*) over (partition by conv_id) as n,
             '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) as piece from t),
w as (select conv_id, n, string_agg(md5(role) || md5(text), '' order by k) as s from n group by conv_id, n),
p as (select distinct md5(string_agg(md5(role) || md5(text), '') over (partition by conv_id order by k)) as h, k
      from n qualify k < max(n) over (partition by conv_id)),
kept as (select min(conv_id) as conv_id from w where not exists (select 1 from p where p.k = w.n and p.h = md5(w.s))
         group by n, s)
select conv_id, cast(floor((k - 1) / 256) as bigint) as part, count(*) as n_turns,
       strlen(string_agg(piece, '' order by k)) as n_bytes, sha256(string_agg(piece, '' order by k)) as rendered_sha256
from n join kept using (conv_id) group by 1, 2
"""


@query
def op5_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through WARC archives and their merged index."""
    captured = F.timestamp_seconds(F.lit(1_600_000_000) + F.coalesce(F.col("page_id"), F.lit(0)))
    index = warc.archive_and_index(table(spark, sf_dir, "pages"), captured=captured)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op5_warc_capture_index"] = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html) as n, sha256(html) as h from p),
f as (select h, min(page_id) as first_id from d where n >= 100 group by h)
select page_id, n as payload_bytes, h as payload_digest,
       case when first_id is null or page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id <> first_id then first_id end as refers_to
from d left join f using (h)
"""


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that stood before, exactly or at one edit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = linededup.dedup_lines(docs, counts=True)
    return found.select(
        "doc_id", "n_exact", "n_near", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


ORACLE["op6_line_dedup"] = r"""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i
           from documents where text is not null),
c as (select line, length(line) as n, min((doc_id, i)) as first from l where line <> '' group by line),
h as (select *, n // 2 as m from c where n >= 20),
p as (select a.line as a, b.line as b, a.first as fa, b.first as fb from h a join h b
        on b.n = a.n and left(a.line, a.m) = left(b.line, b.m) and a.line <> b.line
      union select a.line, b.line, a.first, b.first from h a join h b
        on b.n = a.n and right(a.line, a.n - a.m) = right(b.line, b.n - b.m) and a.line <> b.line
      union select a.line, b.line, a.first, b.first from h a join h b
        on b.n = a.n + 1 and left(a.line, a.m) = left(b.line, (b.n - 1) // 2)
      union select a.line, b.line, a.first, b.first from h a join h b
        on b.n = a.n + 1 and right(a.line, a.n - a.m) = right(b.line, b.n - 1 - (b.n - 1) // 2)),
e as (select * from p where len(list_filter(range(1, length(b) + 1), lambda k:
        left(b, k - 1) = left(a, k - 1) and substr(b, k + 1) = substr(a, case when length(a) = length(b) then k + 1 else k end))) > 0),
near as (select case when fa > fb then a else b end as line from e group by 1),
d as (select doc_id, l.i, l.line, c.first is not null and (l.doc_id, l.i) <> c.first as again, near.line is not null as late
      from l left join c on c.line = l.line left join near on near.line = l.line),
s as (select doc_id, count(*) filter (again) as n_exact, count(*) filter (late and not again) as n_near,
             coalesce(string_agg(line, chr(10) order by i) filter (not again and not late), '') as kept
      from d group by doc_id)
select doc_id, cast(coalesce(n_exact, 0) as int) as n_exact, cast(coalesce(n_near, 0) as int) as n_near,
       sha256(coalesce(kept, '')) as text_sha256
from documents left join s using (doc_id)
"""


@query
def op7_interpolated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of every document; a tenth of them is held out from counting."""
    rest = remainder(F.col("doc_id"), 10)
    role = F.when(rest == 0, lm.SCORED).when(rest == 1, lm.DELETED).when(rest.isNotNull(), lm.KEPT)
    found = lm.score(table(spark, sf_dir, "documents"), role=role)
    return found.select(
        "doc_id", held_out(F.col("doc_id"), 10, 0).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


@query
def op8_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages of ten words in every document."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontam.hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


ORACLE["op9_benchmark_decontamination"] = r"""
with d as (select row_number() over () as r, doc_id,
                  coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents),
b as (select distinct item_id,
             regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
items as (select item_id, w, least(len(w), 10) as m from b where len(w) > 0),
windows as (select distinct item_id, m, array_to_string(w[i:i + m - 1], ' ') as gram
            from (select item_id, w, m, unnest(range(1, len(w) - m + 2)) as i from items)),
places as (select r, w, m, unnest(range(1, len(w) - m + 2)) as i
           from d, (select distinct m from windows) where len(w) >= m),
hits as (select r, p.m, i, item_id from (select r, m, i, array_to_string(w[i:i + m - 1], ' ') as gram from places) p
         join windows v on p.m = v.m and p.gram = v.gram),
words as (select r, count(distinct j) as n_hit from (select r, unnest(range(i, i + m)) as j from hits) group by r),
named as (select r, count(*) as n_items, string_agg(id, ',' order by id) as ids
          from (select distinct r, cast(item_id as varchar) as id from hits where item_id is not null) group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join named using (r)
"""


@query
def op10_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of held-out documents are not learned."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), learn_from=remainder(F.col("doc_id"), 5) != 0)
    scored = quality.score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each source, in every order."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op11_filter_audit"] = r"""
with t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents),
d as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by text) as first_id from t),
m as (select doc_id, part,
             case when len(w) < 200 then 1 else 0 end
             + case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end
             + case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) then 4 else 0 end
             + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end
             + case when doc_id > first_id then 16 else 0 end as mask from d),
g as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
      from labels group by doc_id),
c as (select part, mask, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic,
             120 * count(*) // greatest(bit_count(mask), 1) as share
      from m left join g using (doc_id) group by part, mask),
f as (select chr(cast(65 + i as integer)) as x, 1 << i as b from (select unnest(range(0, 5)) as i)),
o as (select v.x || w.x || y.x || z.x || u.x as filter_order, [v.b, w.b, y.b, z.b, u.b] as bits
      from f v join f w on w.x <> v.x join f y on y.x not in (v.x, w.x) join f z on z.x not in (v.x, w.x, y.x)
      join f u on u.x not in (v.x, w.x, y.x, z.x)),
s as (select filter_order, cast(step as integer) as step, bits[step] as bit, cast(coalesce(list_sum(bits[1:step - 1]), 0) as bigint) as before
      from (select *, unnest(range(1, 6)) as step from o))
select part, filter_order, step,
       coalesce(sum(n) filter (mask & (before | bit) = 0), 0)::bigint as kept,
       coalesce(sum(n) filter (mask & bit <> 0 and mask & before = 0), 0)::bigint as removed,
       coalesce(sum(n) filter (mask & bit <> 0 and mask & before <> 0), 0)::bigint as redundant,
       coalesce(sum(n) filter (mask = bit), 0)::bigint as unique_fails,
       coalesce(sum(good) filter (mask & bit <> 0 and mask & before = 0), 0)::bigint as good_lost,
       coalesce(sum(toxic) filter (mask & bit <> 0 and mask & before = 0), 0)::bigint as toxic_lost,
       coalesce(sum(share) filter (mask & bit <> 0), 0)::bigint as shapley
from s, c group by part, filter_order, step
"""


@query
def op12_bpe_round_trip(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Every document as ids of a public vocabulary and back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    vocabulary = bpe.load(tokenizer)
    ids = bpe.encode(table(spark, sf_dir, "documents"), vocabulary, ["doc_id"])
    found = bpe.decode(ids, vocabulary, ["doc_id", "ids"])
    return found.select(
        "doc_id", bpe.count("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256")
    )


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every hundredth vector."""
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLE["op13_hard_negatives"] = """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
           from embeddings where label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, a.label = e.label as same, e.vec_id, cast(list_inner_product(a.v, e.v) as bigint) as score
      from e a join e on e.vec_id <> a.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
       vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 10
"""
