"""The registered queries of this subpackage: each applies its operator to a whole table and digests what it returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, extract, kneser_ney, packing, phrases, pivots, postings, repeats, setsketch, sharding, toxicity, walsh
from .shared import seen_by_workers, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    seen_by_workers(spark)
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(found.select("doc_id", "text")) if name == "documents" else found


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.conversations(chat.linear(rows.unionByName(own))))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return back.select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP1_SQL = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e as (
  select *, replace(replace(replace(text, '\', '\\'), '<', '\('), '>', '\)') as shown_text,
            replace(replace(replace(role, '\', '\\'), '<', '\('), '>', '\)') as shown_role from t
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length('<turn:') + length(shown_role) + 2 + length(shown_text) + length('</turn>') + 2)::bigint as formatted_chars
from e group by conv_id
"""


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.tiktoken")
    both = bpe.decode(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path), path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.read_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=16)
    body = F.coalesce("text", F.lit(""))
    return dealt.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(F.encode(body, "utf-8")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def remainder(key: str, by: int):
    """crc32(key as text) mod by; null for a null key."""
    return F.pmod(F.crc32(F.encode(F.col(key).cast("string"), "utf-8")), F.lit(by))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(remainder("doc_id", 7) == 2, F.lit(False)).alias("held_out"))
    model = kneser_ney.train(docs.where("not held_out"))
    return kneser_ney.perplexity(docs, model).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=100)
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    return cut.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Fitted on labelled documents whose crc32 remainder by 3 is not 1; a document's labels count once, 1 before 0."""
    labels = table(spark, sf_dir, "labels").where("toxic is not null and doc_id is not null").where(remainder("doc_id", 3) != 1)
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    wanted = F.broadcast(labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(toxicity.Settings.most_rows))
    return toxicity.fit(table(spark, sf_dir, "documents").select("doc_id", "text").join(wanted, "doc_id"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return postings.search(vectors, vectors.where("vec_id % 50 = 0"))


def op9_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op10_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), setsketch.Settings(shingle=3, percent=85))


def op11_walsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = walsh.encode(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return walsh.with_label_errors(coded).select(F.col("key").alias("vec_id"), "code", "error", "label_error", F.lit(walsh.digest(coded.books)).alias("codebooks_sha256"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen_by_workers(spark)
    return phrases.collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op13_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"))).select("page_id", "url", "text", "n_chars")


# Components in SQL: every row takes the least key of its neighbours until nothing changes.
OP9_SQL = """
with recursive good as (select vec_id, embedding::double[] as v from embeddings where vec_id is not null and embedding is not null and len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit as (select vec_id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) as u from good),
links as (select p.vec_id as a, q.vec_id as b from unit p join unit q on p.vec_id <> q.vec_id and list_dot_product(p.u, q.u) >= 0.9),
hooks as (select vec_id as a, vec_id as least from unit union select l.b, h.least from hooks h join links l on l.a = h.a where h.least < l.b),
per as (select a, min(least) as component_id from hooks group by a)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, coalesce(p.component_id, e.vec_id) as component_id, e.vec_id = coalesce(p.component_id, e.vec_id) as kept
from embeddings e left join (select a, count(*) as n from links group by a) n on n.a = e.vec_id left join per p on p.a = e.vec_id
"""

OP10_SQL = r"""
with recursive split as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingle as (select distinct doc_id, case when len(w) >= 3 then array_to_string(w[i:i + 2], ' ') else array_to_string(w, ' ') end as s from (select *, unnest(generate_series(1, greatest(len(w) - 2, 1))) as i from split where len(w) > 0)),
size as (select doc_id, count(*) as n from shingle group by 1),
own as (select doc_id, md5(string_agg(s, chr(10) order by s)) as h from shingle group by 1),
least as (select h, min(doc_id) as doc_id from own group by 1),
picked as (select s.* from shingle s join least using (doc_id)),
rare as (select s, doc_id from picked where s in (select s from picked group by s having count(*) > 1)),
links as (select c.a, c.b from (select p.doc_id as a, q.doc_id as b, count(*) as n from rare p join rare q on p.s = q.s and p.doc_id <> q.doc_id group by 1, 2) c join size x on x.doc_id = c.a join size y on y.doc_id = c.b where 100 * c.n >= 85 * (x.n + y.n - c.n)),
hooks as (select doc_id as a, doc_id as least from least union select l.b, k.least from hooks k join links l on l.a = k.a where k.least < l.b),
per as (select a, min(least) as component_id from hooks group by a)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(p.component_id, d.doc_id) as component_id, d.doc_id = coalesce(p.component_id, d.doc_id) as kept
from documents d left join size using (doc_id) left join own using (doc_id) left join least on least.h = own.h left join per p on p.a = least.doc_id
"""

# A round of assignment in SQL: every part against its codebook's entries; then the floored means.
_ASSIGN = "{to} as (select vec_id, row, part, x, min(far) as far, arg_min(entry, far * 64 + entry) as entry from (select p.*, b.entry, list_sum(list_transform(generate_series(1, len(x)), lambda i: (x[i] - b.e[i]) * (x[i] - b.e[i]))) as far from parts p join {book} b using (part)) group by 1, 2, 3, 4)"
_LEARN = """{to} as (select b.part, b.entry, coalesce(m.e, b.e) as e from {book} b left join (select part, entry, list(e order by i) as e from (
  select part, entry, i, floor_div(sum(x[i]), count(*)) as e from {of}, generate_series(1, (select max(len(x)) from parts)) g(i) group by all) group by 1, 2) m using (part, entry))"""
OP11_SQL = f"""
with kept as (select vec_id, label, row_number() over (order by vec_id nulls last, embedding) as row, list_transform(embedding, lambda c: floor(c::double * 256)::bigint) as v from embeddings
  where embedding is not null and len(embedding) = 64 and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
parts as (select vec_id, row, p as part, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] as x from kept, generate_series(0, 15) g(p)),
book0 as (select part, row - 1 as entry, x as e from parts where row <= 64),
{_ASSIGN.format(to='near1', book='book0')}, {_LEARN.format(to='book1', book='book0', of='near1')},
{_ASSIGN.format(to='near2', book='book1')}, {_LEARN.format(to='book2', book='book1', of='near2')}, {_ASSIGN.format(to='near3', book='book2')},
coded as (select row, string_agg(lower(printf('%02x', entry)), '' order by part) as code, sum(far)::bigint as error from near3 group by 1),
said as (select sha256(coalesce(string_agg(array_to_string(e, ','), ',' order by part, entry), '')) as codebooks_sha256 from book2)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from kept join coded using (row), said
""".replace("floor_div(sum(x[i]), count(*))", "((sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*))::bigint")

OP12_SQL = r"""
with split as (select doc_id, row_number() over () as d, coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
pieces as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from split),
grams as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as g from (select *, unnest(generate_series(1, len(w))) as i from pieces), generate_series(1, 3) t(k) where i + k - 1 <= len(w)),
f as materialized (select lang, k, g, count(*) as n from grams group by 1, 2, 3),
size as (select lang, sum(n)::bigint as n from f where k = 1 group by 1),
candidate as materialized (select lang, k, g, string_split(g, ' ') as w, n as a from f where k > 1 and n >= 10),
halves as (select lang, k, g, a, j, array_to_string(w[1:j], ' ') as g1, array_to_string(w[j + 1:], ' ') as g2 from candidate, generate_series(1, 2) t(j) where j < k),
first as materialized (select c.*, x.n as l from halves c join f x on x.lang = c.lang and x.g = c.g1),
cut as (select c.*, y.n as r, (1000000 * c.a::hugeint * c.a // (c.l::hugeint * y.n))::bigint as score from first c join f y on y.lang = c.lang and y.g = c.g2),
lowest as (select lang, g, a, arg_min(l, score * 4 + j) as l, arg_min(r, score * 4 + j) as r, min(score) as score from cut group by 1, 2, 3),
inside as (select lang, array_to_string(w[i:i + 1], ' ') as g, max(a) as most from candidate, generate_series(1, 2) t(i) where k = 3 group by 1, 2),
kept as (select o.lang, o.g as phrase, a, l, r, score from lowest o left join inside i on i.lang = o.lang and i.g = o.g where most is null or 100 * most < 50 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join size using (lang) where rank <= 2000
"""


QUERIES = {
    "op1_chat": op1_chat, "op2_bpe": op2_bpe, "op3_sharding": op3_sharding, "op4_kneser_ney": op4_kneser_ney, "op5_repeats": op5_repeats,
    "op6_toxicity": op6_toxicity, "op7_packing": op7_packing, "op8_postings": op8_postings, "op9_pivots": op9_pivots, "op10_setsketch": op10_setsketch,
    "op11_walsh": op11_walsh, "op12_phrases": op12_phrases, "op13_extract": op13_extract,
}
ORACLES = {"op1_chat": OP1_SQL, "op9_pivots": OP9_SQL, "op10_setsketch": OP10_SQL, "op11_walsh": OP11_SQL, "op12_phrases": OP12_SQL}
