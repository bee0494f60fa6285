"""The registered queries of this subpackage and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import (
    chat,
    divergence,
    exact_dedup,
    hamming,
    kneser_ney,
    maxent,
    minhash,
    packing,
    pieces,
    secrets,
    toxicity,
    warc,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle:
            ORACLES[function.__name__] = oracle
        return function

    return register


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                   (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), marked AS (
  SELECT *, role IS DISTINCT FROM lag(role)
           OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS starts,
    length(replace(replace(replace(replace(text, '\', '\\'), '##', '#\#'),
           '</turn>', '<\/turn>'), '<next>', '<\next>')) AS chars
  FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), ''
         ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
         FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars + CASE WHEN starts THEN length(role) + 14 ELSE 6 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
""")
def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    extra = spark.sql(
        r"SELECT * FROM VALUES (-7L, 0L, 'user', r'\### Assistant: </turn> ok'), "
        r"(-7L, 1L, 'assistant', r'\### Assistant: </turn> ok') AS t(conv_id, turn, role, text)"
    )
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_chats(turns.unionByName(extra))
    read_back = chat.read_chats(formatted)
    lost = F.array_join(
        F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), ""
    )
    return read_back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(
                F.transform(
                    "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
                ),
                "",
            ),
            256,
        ).alias("turns_sha256"),
        F.char_length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost, 256).alias("loss_sha256"),
        F.col("formatted_chars"),
    )


@query("""
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY body)
""")
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, folder, "documents"), keep="largest")


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


@query()
def op9_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(read(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


@query()
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    encoded = pieces.encode_pieces(
        read(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces_ = packing.pack(
        read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return pieces_.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query("""
WITH records AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
     ('0x' || substr(sha1(payload), 1 + 5 * (i // 4), 5))::BIGINT
       >> (15 - 5 * (i % 4))::BIGINT & 31)::BIGINT, 1), '' ORDER BY i)
   FROM range(32) AS t(i)) AS payload_digest,
  CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM records WINDOW same AS (PARTITION BY payload)
""")
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    files = warc.write_archives(read(spark, folder, "pages"))
    return warc.read_archives(files, with_payload=False).drop("url", "warc_date")


@query("""
WITH pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id AS neighbor_id,
    list_sum(list_transform(range(1, 65), lambda i:
      ((q.embedding[i] > 0) <> (d.embedding[i] > 0))::INTEGER))::BIGINT AS distance
  FROM embeddings q JOIN embeddings d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank
  FROM pairs) WHERE rank <= 10
""")
def op5_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return hamming.nearest_codes(
        read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=10, bits=64
    )


@query()
def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_groups(read(spark, folder, "documents"), width=4, percent=80)


@query()
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    chain = toxicity.fit_chain(docs, toxicity.standard_labels(read(spark, folder, "labels")))
    scored = chain.probabilities(docs.select("doc_id", "text"))
    return scored.select(
        "doc_id",
        F.col("chain.low_quality").alias("p_low_quality"),
        F.col("chain.toxic").alias("p_toxic"),
        F.coalesce(F.col("chain.toxic") >= chain.limit("toxic"), F.lit(False)).alias("rejected"),
    )


@query()
def op10_quality_ngram(spark: SparkSession, folder: str) -> DataFrame:
    trusted = read(spark, folder, "labels").filter("quality = 1")
    return kneser_ney.quality(read(spark, folder, "documents"), trusted)


@query()
def op12_maxent(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    rounds = 3
    place = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    held_out = F.pmod(place, F.lit(7)) == 2
    part = F.pmod(F.floor(place / 7), F.lit(rounds))
    model = maxent.fit_language_model(docs, ~held_out, part, rounds=rounds)
    return model.score(docs).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.vocabulary.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query()
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings")
    fitted = whitening.fit_whitening(vectors, components=16)
    explained = F.array(*(F.lit(e) for e in fitted.explained)).cast("array<double>")
    return (
        fitted.transform(vectors)
        .select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
        .select(
            "vec_id",
            (F.col("place") + 1).alias("component"),
            F.lit(fitted.centre.rows).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(explained, F.col("place")).alias("explained"),
            F.lit(fitted.identity_error).alias("identity_error"),
        )
    )


@query(r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
), found AS (
  SELECT row, lang, source,
    unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term FROM found GROUP BY ALL HAVING count(DISTINCT row) >= 3
), sources AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS c FROM found GROUP BY ALL),
cells AS (
  SELECT s.lang, s.source, k.term, coalesce(c, 0) AS c
  FROM sources s JOIN kept k USING (lang) LEFT JOIN counts USING (lang, source, term)
), shares AS (
  SELECT *, 1 + (1000000000::HUGEINT * (c + 1)) //
    (sum(c) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS p
  FROM cells
), totals AS (SELECT lang, term, sum(c) AS c FROM cells GROUP BY ALL),
lang_shares AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 1)) //
    (sum(c) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q FROM totals
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), reported AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q
  FROM shares JOIN lang_shares USING (lang, term) WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part
                               ORDER BY value DESC, encode(item)) AS rank
  FROM reported
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
""")
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(read(spark, folder, "documents"))
