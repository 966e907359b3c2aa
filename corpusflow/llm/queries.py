"""The registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import bpe, chat, collocations, language, licenses, lines, minhash, repeats, scoring, sharding, tiling, tries, vectors
from corpusflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


@query("op1_minhash")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.components(table(spark, folder, "documents"), n=2, least=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op2_repeats")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeated_spans(table(spark, folder, "documents"))


@query("op3_vectors")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.components(table(spark, folder, "embeddings"))


@query("op4_lines")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    done = lines.dedup_lines(table(spark, folder, "documents"))
    kept = F.coalesce(F.col("text"), F.lit(""))
    return done.select(
        "doc_id", F.size("removed").cast("long").alias("n_removed"), F.array_join("removed", ",").alias("removed"),
        F.sha2(kept, 256).alias("text_sha256"),
    )


@query("op5_language")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    apart = language.held_out(F.col("doc_id"))
    model = language.fit(docs.where(~apart))
    found = docs.select("doc_id", apart.alias("held_out"), language.predict(docs, model).alias("p"))
    return found.select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
        F.col("p.ambiguous").alias("ambiguous"),
    )


def vocabulary() -> str:
    """Where the public tokenizer file lies; the only place that names it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op6_bpe")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    encode, decode = bpe.encoder(spark, vocabulary()), bpe.decoder(spark, vocabulary())
    coded = docs.select("doc_id", encode(F.col("text")).alias("ids"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids")), 256).alias("decoded_sha256"),
    )


@query("op7_tiling")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = tiling.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", F.col("item").alias("item_id"), F.col("n_words").cast("long").alias("n_words"),
        F.col("covered").cast("long").alias("covered"), F.size("tiles").cast("long").alias("n_tiles"),
    )


@query("op8_licenses")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses_of(table(spark, folder, "documents"))


@query("op9_sharding")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_by_bytes(table(spark, folder, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op10_chat")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    template = chat.Template()
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"),
    )
    done = chat.format_chat(turns.unionByName(more), template)
    # What follows reads the output alone.
    back = done.withColumn("turns", chat.read_turns(F.col("formatted"), template))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescape(s["text"], template))
    return back.withColumn("learnt", F.array_join(learnt, "")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


OP11_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, doc_id,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\n\x0b\x0c\r]')) as piece
  from documents),
lists as (select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') as w from pieces),
places as (select lang, w, unnest(range(1, len(w) + 1)) as i from lists),
grams as (
  select lang, w[i] as w1, case when s >= 2 then w[i + 1] end as w2, case when s = 3 then w[i + 2] end as w3, count(*) as f
  from places, (values (1), (2), (3)) as sizes(s) where i + s - 1 <= len(w) group by all),
f1 as (select lang, w1, f from grams where w2 is null),
f2 as (select lang, w1, w2, f from grams where w2 is not null and w3 is null),
f3 as (select lang, w1, w2, w3, f from grams where w3 is not null),
cuts as (
  select p.lang, p.w1, p.w2, null as w3, p.f as a, 1 as k, x.f as l, y.f as r
  from f2 p join f1 x on x.lang = p.lang and x.w1 = p.w1 join f1 y on y.lang = p.lang and y.w1 = p.w2 where p.f >= 10
  union all
  select p.lang, p.w1, p.w2, p.w3, p.f, 1, x.f, y.f
  from f3 p join f1 x on x.lang = p.lang and x.w1 = p.w1 join f2 y on y.lang = p.lang and y.w1 = p.w2 and y.w2 = p.w3 where p.f >= 10
  union all
  select p.lang, p.w1, p.w2, p.w3, p.f, 2, x.f, y.f
  from f3 p join f2 x on x.lang = p.lang and x.w1 = p.w1 and x.w2 = p.w2 join f1 y on y.lang = p.lang and y.w1 = p.w3 where p.f >= 10),
scored as (
  select *, (cast(1000000 as hugeint) * a * a // (cast(l as hugeint) * r))::bigint as score from cuts),
worst as (
  select * from scored qualify row_number() over (partition by lang, w1, w2, w3 order by score, k) = 1),
kept as (
  select * from worst c where not (w3 is null and exists (
    select 1 from worst t where t.w3 is not null and t.lang = c.lang and 100 * t.a >= 50 * c.a
      and ((t.w1 = c.w1 and t.w2 = c.w2) or (t.w2 = c.w1 and t.w3 = c.w2))))),
words as (select lang, sum(f)::bigint as n from f1 group by lang)
select k.lang, row_number() over (
    partition by k.lang order by score desc, a desc, concat_ws(' ', w1, w2, w3)) as rank,
  concat_ws(' ', w1, w2, w3) as phrase, a, l, r, n, score
from kept k join words on words.lang = k.lang qualify rank <= 2000
"""


@query("op11_collocations", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


OP12_SQL = r"""
with own as (
  select conv_id as c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} order by turn nulls first, role, text) as seq
  from conversations where conv_id is not null group by conv_id),
hashed as (
  select c, seq, xor(4294967295, list_reduce(
      list_concat([4294967295::bigint], list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % 4 as h
  from own),
rebuilt as (
  select x.c, list_concat(case when b.c is null then [] else b.seq[1:x.h] end, x.seq[x.h + 1:]) as seq
  from hashed x left join own b on b.c = x.c - x.c % 20),
prefixes as (select c, len(seq) as size, d, seq[1:d] as p from (select *, unnest(range(0, len(seq) + 1)) as d from rebuilt)),
nodes as (
  select p, d, min(c) as conv_id, count(*) as n_convs, string_agg(c::varchar, ',' order by c) filter (size = d) as ends,
    case when d = 0 then 0 else len(regexp_extract_all(p[d].t, '[^\x20\x09-\x0D]+')) end as words
  from prefixes group by p, d),
kids as (select p[1:d - 1] as up, count(*) as n from nodes where d > 0 group by 1),
facts as (select n.*, coalesce(k.n, 0) as n_children from nodes n left join kids k on k.up = n.p),
sums as (
  select p[1:a] as top, count(*) filter (n_children = 0) as n_leaves, sum((n_convs - 1) * words)::bigint as saved_tokens
  from (select *, unnest(range(0, d + 1)) as a from facts) group by 1)
select f.conv_id, f.d::bigint as depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens,
  sha256(coalesce(f.ends, '')) as ends_sha256
from facts f join sums s on s.top = f.p left join nodes u on f.d > 0 and u.p = f.p[1:f.d - 1]
"""


@query("op12_trie", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    seqs = tries.with_shared_starts(tries.sequences(table(spark, folder, "conversations")))
    return tries.nodes(seqs).drop("turn")


@query("op13_scoring")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    apart = language.held_out(F.col("doc_id"), folds=7, fold=2)
    found = scoring.score_texts(table(spark, folder, "documents"), ~apart)
    return found.select(
        F.col("id").alias("doc_id"), (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "bits_per_byte",
    )
