"""The registered queries of this package: query key -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ontime.llm import (chat, decontaminate, embeddings, extraction, hpylm, language, packing, ranking,
                        shingles, substrings, toxicity, urls, vectorcodes)
from ontime.llm.sampling import remainder
from ontime.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _is(doc_id: str, n: int, fold: int) -> Column:
    """Whether the id's remainder is ``fold``; a null id's is not."""
    return F.coalesce(remainder(doc_id, n) == fold, F.lit(False))


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = toxicity.fit(docs, labels.where(remainder("doc_id", 5) != 0))
    return toxicity.score(docs, weights).select("doc_id", _is("doc_id", 5, 0).alias("held_out"), "score",
                                                "predicted")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.fit(spark))


def op3_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = _is("doc_id", 7, 2)
    scored = hpylm.score(docs, hpylm.fit(docs.where(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingles.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_turns(rows))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(remainder("doc_id", 3) != 1))
    return language.predict(docs, model).select("doc_id", _is("doc_id", 3, 1).alias("held_out"),
                                                "lang_pred", "score")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"), extraction.fit(spark))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vectorcodes.compress(table(spark, sf_dir, "embeddings"))
    folder = shared_dir(spark, "vector-codes")
    coded.write.parquet(folder)
    whole = vectorcodes.with_label_error(spark.read.schema(coded.schema).parquet(folder))
    return whole.select("vec_id", "code", "error", "label_error",
                        F.lit(vectorcodes.digest(books)).alias("codebooks_sha256"))


# ---- stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame ------------------------------

def identified_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified(docs, language.calibrated(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shingles.one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    counts = ("n_words", "n_removed")     # columns of that name are the documents' own here
    rows = docs.withColumnsRenamed({c: f"__llm_{c}" for c in counts if c in docs.columns})
    kept = substrings.remove_repeated(rows).drop(*counts).withColumnsRenamed({f"__llm_{c}": c for c in counts})
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _pieces(docs)


def _pieces(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, word_bpe()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "sequence_tokens", "loss_tokens")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filter": op2_url_filter,
    "op3_hpylm": op3_hpylm,
    "op4_ngram_join": op4_ngram_join,
    "op5_decontaminate": op5_decontaminate,
    "op6_chat_format": op6_chat_format,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_html_text": op12_html_text,
    "op13_vector_codes": op13_vector_codes,
}

_OP6 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), formatted AS (
  SELECT *, '### ' || replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '<', '\l'), chr(10), '\n')
    || chr(10) || replace(replace(replace(text, '\', '\\'), '#', '\#'), '<', '\l') || '</turn>' || chr(10) AS f
  FROM turns
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, f)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, f) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(f)) AS BIGINT) AS formatted_chars
FROM formatted GROUP BY conv_id
"""

_TERMS = r"""list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
    lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"""

_OP11 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, {_TERMS} AS terms FROM documents
), corpus AS (
  SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0
), asked AS (
  SELECT row_number() OVER () AS q, item_id, {_TERMS} AS terms
  FROM (SELECT DISTINCT CAST(item_id AS BIGINT) AS item_id, coalesce(text, '') AS text FROM benchmark)
), wanted AS (
  SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(terms) AS term FROM asked) GROUP BY q, item_id, term
), held AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY r, doc_id, n, term
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, corpus GROUP BY term, n_docs
), scored AS (
  SELECT q, item_id, r, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms))))) AS BIGINT) AS score
  FROM held JOIN weight USING (term) JOIN wanted USING (term), corpus GROUP BY q, item_id, r, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
) WHERE rank <= 20
"""

_OP13 = """
WITH RECURSIVE kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, vec_id, label, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS x
  FROM kept, (SELECT unnest(range(8)) AS p)
), books(round, p, e, entry) AS (
  SELECT 0, p, r - 1, x FROM parts WHERE r <= 16
  UNION ALL
  SELECT b.round + 1, b.p, b.e, coalesce(n.entry, b.entry)
  FROM books b LEFT JOIN (
    SELECT p, e, list(CAST(floor_mean AS BIGINT) ORDER BY place) AS entry
    FROM (
      SELECT p, e, place, CASE WHEN s >= 0 THEN s // c ELSE -((-s + c - 1) // c) END AS floor_mean
      FROM (
        SELECT p, e, place, sum(c) AS s, count(*) AS c
        FROM (
          SELECT a.p, a.k % 16 AS e, unnest(a.x) AS c, unnest(range(len(a.x))) AS place
          FROM (
            SELECT t.p, t.r, any_value(t.x) AS x,
              min(CAST(list_sum(list_transform(list_zip(t.x, o.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * 16 + o.e) AS k
            FROM parts t JOIN books o ON t.p = o.p GROUP BY t.p, t.r
          ) a
        ) GROUP BY p, e, place
      )
    ) GROUP BY p, e
  ) n ON b.p = n.p AND b.e = n.e
  WHERE b.round < 6
), final AS (SELECT p, e, entry FROM books WHERE round = 6),
coded AS (
  SELECT t.r, any_value(t.vec_id) AS vec_id, any_value(t.label) AS label, t.p,
    min(CAST(list_sum(list_transform(list_zip(t.x, o.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * 16 + o.e) AS k
  FROM parts t JOIN final o ON t.p = o.p GROUP BY t.r, t.p
), rows_ AS (
  SELECT r, any_value(vec_id) AS vec_id, any_value(label) AS label,
    string_agg(printf('%02x', k % 16), '' ORDER BY p) AS code, CAST(sum(k // 16) AS BIGINT) AS error
  FROM coded GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) FROM final) AS codebooks_sha256
FROM rows_
"""

ORACLES: dict[str, str] = {
    "op11_ranked_search": _OP11,
    "op13_vector_codes": _OP13,
    "op6_chat_format": _OP6,
}
