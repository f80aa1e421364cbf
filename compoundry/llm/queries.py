"""The registered queries of the subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import split_hot_join
from . import chats, counts, fingerprints, licenses, markov, minmax, negatives, packing, pieces, quality, secrets, sharding, tries
from .common import documents, durable, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document with an end id, and the text decoded from them, as digests."""
    path = tokenizer("piece_bpe_32k.model")
    encoded = pieces.encode(documents(spark, sf_dir), path).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
    )
    decoded = pieces.decode(encoded, path, ("doc_id", "n_tokens", "ids_sha256"))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir)).drop("spans")


def license_oracle() -> str:
    """Votes by diagonal in SQL; the templates' pairs stand in it as values."""
    templates = [*licenses.PHRASES, *licenses.NOTICES]
    rows = ", ".join(
        f"('{t.label}', {str(t.exact).lower()}, {q}, {len(w) - 1}, '{w[q]} {w[q + 1]}')"
        for t in templates for w in [t.words.split()] for q in range(len(w) - 1))
    return rf"""
with d as (select row_number() over () as r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
g as (select r, i - 1 as p, ws[i] || ' ' || ws[i + 1] as pair from (select r, ws, unnest(range(1, len(ws))) as i from d)),
t(label, base, q, m, pair) as (values {rows}),
h as (select r, label, base, m, p, q, p - q as dg from g join t using (pair)),
v as (select r, label, base, m, dg, count(distinct q) as n from h group by all),
f as (select r, label, dg as s, 1.0::double as cover, true as base from v where base and n = m),
c as (select r, label, dg, sum(head) over (partition by r, label order by dg) as run from
      (select r, label, dg, case when dg - lag(dg) over (partition by r, label order by dg) > {licenses.GAP} then 1 else 0 end as head
       from v where not base)),
x as (select r, label, m, run, count(distinct q) as n, min(p) as s, max(p) + 2 as e
      from h join c using (r, label, dg) group by all),
y as (select r, label, s, n / m as cover, false as base from x
      where 100 * n >= {licenses.COVER} * m and 100 * (e - s) <= {licenses.LENGTH} * (m + 1)),
z as (select * from f union all select * from y),
o as (select r, count(*) filter (where base) as n_base, min(s) filter (where base) as first_word,
             max(s) filter (where base) as last_word,
             string_agg(distinct label, ',' order by label) filter (where base) as base_labels,
             string_agg(distinct label, ',' order by label) as labels, max(cover) as score from z group by r)
select doc_id, len(ws)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
       last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
       coalesce(score, 0)::double as score
from d left join o using (r)
"""


ORACLES["op2_license_scans"] = license_oracle()


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir))
    return judged.select("_row.doc_id", *quality.MEASURES, "base_failed", "kept")


ORACLES["op5_quality_rules"] = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
g as (select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as gram
      from (select r, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 3)),
twice as (select r, i from (select r, i, count(*) over (partition by r, gram) as n from g) where n > 1),
hit as (select r, count(distinct i + k) as n from twice, (values (0), (1), (2)) as o(k) group by r),
m as (select doc_id, ws, ls, t, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
             len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(hit.n, 0) as n_repeat_words
      from w left join hit using (r)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
       not (base_failed or 100 * n_symbols > 20 * n_words or 100 * n_dup_lines > 40 * len(ls)
            or word_chars < 2 * n_words or word_chars > 15 * n_words
            or 100 * len(list_filter(ws, lambda x: regexp_matches(x, '\pL'))) < 70 * n_words
            or 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 60 * word_chars) as kept
from b
"""


@query
def op6_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.linked(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document, by models trained on labelled samples of the table."""
    docs = documents(spark, sf_dir)
    scanned = secrets.scan(docs, secrets.train(secrets.labelled(docs)))

    def n(kind: int):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(
        "_row.doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(secrets.span_text(F.filter("secrets", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        secrets.span_text(F.col("secrets")).alias("spans"),
    )


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints, and classes of near copies."""
    return fingerprints.whole(documents(spark, sf_dir))


SHARDS = [f"shard-{k:03d}" for k in range(128)]


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, and the one it has when one more shard joins."""
    rows = documents(spark, sf_dir).select("doc_id")
    both = sharding.place(sharding.place(rows, "doc_id", SHARDS), "doc_id", [*SHARDS, "shard-128"], "next_shard")
    return both.select("doc_id", "slot", "shard", "next_shard")


def sharding_oracle() -> str:
    def listed(shards: list[str]) -> str:
        return "[" + ", ".join(f"'{s}'" for s in sharding.fill(shards)) + "]"

    return f"""
with k as (select doc_id, ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 8))::bigint % {sharding.SLOTS} as slot from documents),
t as (select {listed(SHARDS)} as a, {listed([*SHARDS, 'shard-128'])} as b)
select doc_id, slot::int as slot, a[slot + 1] as shard, b[slot + 1] as next_shard from k, t
"""


ORACLES["op9_sharding"] = sharding_oracle()

TOOLS = {
    "search": {"query": (chats.STRING, True), "limit": (chats.WHOLE, True), "exact": (chats.TRUTH, False)},
    "fetch": {"query": (chats.STRING, True), "weight": (chats.NUMBER, False)},
}


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations read as tool use: a user's turn is a call, which uses the result of the user's turn before it;
    the assistant's turn that follows is its result; a turn of any other role is a message. Arguments hang on the text,
    so that some break the schema."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    n, own = F.length("text"), F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    calls = said.filter("role = 'user'").select(
        "conv_id", "turn", own.alias("call_id"),
        F.when(F.col("turn") >= 2, F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("turn") - 2).cast("string"))).alias("after"),
        F.when(n % 7 == 0, "fetch").when(n % 11 == 0, "guess").otherwise("search").alias("name"),
        F.when(n % 13 == 0, F.lit("not json")).otherwise(F.to_json(F.struct(
            F.col("text").alias("query"), F.when(n % 3 != 0, n).alias("limit"),
            F.when(n % 5 == 0, F.lit("yes")).alias("exact")))).alias("arguments"))
    results = said.filter("role = 'assistant'").select(
        "conv_id", "turn", F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        F.col("text").alias("content"))
    others = said.filter("role is null or role not in ('user', 'assistant')").select(
        "conv_id", "turn", "role", F.col("text").alias("content"))
    linked = chats.link(calls, results, TOOLS).unionByName(chats.messages(others))
    return linked.withColumn("faults", F.array_join("faults", ","))


ORACLES["op10_chat_format"] = r"""
with recursive s as (select conv_id, turn, role, text, length(text) as n from conversations),
c as (select conv_id, turn, conv_id || '-' || turn as call_id, case when turn >= 2 then conv_id || '-' || (turn - 2) end as after,
             case when n % 7 = 0 then 'fetch' when n % 11 = 0 then 'guess' else 'search' end as name, n, text,
             n % 13 <> 0 as good, n % 3 <> 0 as has_limit, n % 5 = 0 as has_exact from s where role = 'user'),
u as (select distinct call_id, after from c),
l as (select call_id, 0 as depth from u where after is null or after not in (select call_id from u)
      union all select u.call_id, l.depth + 1 from u join l on u.after = l.call_id),
r as (select conv_id, turn, conv_id || '-' || (turn - 1) as call_id, text from s where role = 'assistant')
select conv_id, turn, 'call' as kind, call_id, 2 * depth::bigint as level,
       call_id in (select call_id from r) as linked,
       case when name = 'guess' then 'unknown tool' when not good then 'no object'
            when name = 'fetch' then array_to_string(list_filter([case when has_exact then 'extra exact' end,
                 case when has_limit then 'extra limit' end], lambda x: x is not null), ',')
            else array_to_string(list_filter([case when not has_limit then 'missing limit' end,
                 case when has_exact then 'type exact' end], lambda x: x is not null), ',') end as faults,
       '{' || case when good then '"arguments":{' || case when has_exact then '"exact":"yes",' else '' end
           || case when has_limit then '"limit":' || n || ',' else '' end || '"query":' || to_json(text) || '},' else '' end
           || '"id":' || to_json(call_id) || ',"name":"' || name || '","type":"call"}' as json
from c join l using (call_id)
union all
select conv_id, turn, 'result', call_id, coalesce(2 * depth::bigint + 1, 1), depth is not null,
       case when depth is null then 'no call' else '' end,
       '{"content":' || to_json(text) || ',"id":' || to_json(call_id) || ',"type":"result"}'
from r left join l using (call_id)
union all
select conv_id, turn, 'message', null, 0, false, '',
       '{' || case when text is null then '' else '"content":' || to_json(text) || ',' end
           || case when role is null then '' else '"role":' || to_json(role) || ',' end || '"type":"message"}'
from s where role is null or role not in ('user', 'assistant')
"""


@query
def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by a hidden Markov model; four fifths of the documents train it."""
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return markov.learn_and_score(documents(spark, sf_dir), number % 5 == 1).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every hundredth row, on components of 1/256; labels of every seventh row are moved on by one."""
    rows = table(spark, sf_dir, "embeddings").filter(~F.exists("embedding", lambda x: F.isnan(x) | (F.abs(x) == float("inf"))))
    return negatives.mine(rows.select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vector")))


ORACLES["op12_hard_negatives"] = """
with u as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) as v
           from embeddings
           where vec_id is not null and label is not null and embedding is not null
                 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
      from u as a join u as b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, id)::int as rank,
       id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the conversations, rebuilt to share their first turns with the first of each twenty."""
    turns = tries.ordered(table(spark, sf_dir, "conversations"))
    turns = durable(turns, "ordered")
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    convs = durable(convs.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"), (F.crc32(
        F.col("conv_id").cast("string").cast("binary")) % 4).alias("h")), "convs")
    heads = convs.select("conv_id", "base", "h").join(turns.filter("place < 4").withColumnRenamed("conv_id", "base"), "base").filter(
        "place <= h").select("conv_id", "place", "said", "words")
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    moved = convs.join(lengths, "base", "left").select(
        "conv_id", "h", (F.least("h", F.coalesce("n_base", F.lit(0))) - F.col("h")).alias("by"))
    own = split_hot_join(turns, moved, ["conv_id"], rows_per_split=100_000, unique_right=True, how="left").filter("place > h").select(
        "conv_id", (F.col("place") + F.col("by")).alias("place"), "said", "words")
    members = tries.grow(heads.unionByName(own), convs)
    digests = tries.list_digests(tries.ends(members)).withColumnRenamed("sha256", "ends_sha256")
    return tries.rollup(members).join(digests, "id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


ORACLES["op13_prefix_trie"] = r"""
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null),
k as (select conv_id, turn, md5(length(role) || ':' || role || text) as said,
             len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words from t),
o as (select conv_id, said, words, row_number() over (partition by conv_id order by turn nulls first, said) as place from k),
l as (select conv_id, list(said order by place) as said, list(words order by place) as words, conv_id - conv_id % 20 as base,
             xor(list_reduce(list_concat([4294967295::bigint],
                     list_transform(range(1, length(conv_id::varchar) + 1), lambda i: ascii((conv_id::varchar)[i])::bigint)),
                 lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))),
                 4294967295) % 4 as h
      from o group by conv_id),
r as (select l.conv_id, list_concat(coalesce(b.said[1:l.h], []), l.said[l.h + 1:]) as said,
             list_concat(coalesce(b.words[1:l.h], []), l.words[l.h + 1:]) as words
      from l left join l as b on b.conv_id = l.base),
m as (select conv_id, d, array_to_string(said[1:d], '') as p, coalesce(words[d], 0) as w, d = len(said) as last
      from (select *, unnest(range(0, len(said) + 1)) as d from r)),
n as (select p, d, min(conv_id) as conv_id, count(*) as n_convs, any_value(w) as w,
             sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where last), '')) as ends_sha256
      from m group by p, d),
c as (select left(p, 32 * (d - 1)) as p, count(*) as n_children from n where d > 0 group by 1),
v as (select n.*, coalesce(n_children, 0) as n_children from n left join c using (p)),
s as (select left(p, 32 * k) as p, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum((n_convs - 1) * w) as saved_tokens
      from (select *, unnest(range(0, d + 1)) as k from v) group by 1)
select v.conv_id, v.d::bigint as depth, u.conv_id as parent_conv_id, v.n_convs, v.n_children::bigint as n_children,
       n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, v.ends_sha256
from v join s using (p) left join v as u on v.d > 0 and u.p = left(v.p, 32 * (v.d - 1))
"""
