"""The corpus operators over the driver's tables, each with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.llm import chats, context_tree, decontamination, embeddings, packing, phrases, pii, quality, sharding, simhash, substrings, token_counts, whitening
from cumulo.llm.common import prepare

# For repeatable checks only: a real run passes a secret of its own.
KEY = b"pseudonyms of the check tables"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(prepare(spark), sf_dir)

        QUERIES[name] = configured
        if sql is not None:
            ORACLES[name] = sql.strip()
        return configured

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


@query("op1_feistel_pseudonyms")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(documents(spark, sf_dir), KEY)


@query("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query("op3_weak_label_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("text")


@query("op4_hash_tree_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return sharding.shard(rows, "doc_id", sharding.tree(16))


@query(
    "op5_difference_cover_repeats",
    r"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), windows AS (
        SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s
        FROM words, LATERAL unnest(range(1, len(w) - 11)) AS r(i)
    ), firsts AS (
        SELECT s, min(doc_id) AS d FROM windows GROUP BY s
    ), covered AS (
        SELECT DISTINCT doc_id, i + k AS at
        FROM windows JOIN firsts USING (s), range(0, 13) AS o(k)
        WHERE d < doc_id
    ), kept AS (
        SELECT words.doc_id, words.p, words.word
        FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words) AS words
        ANTI JOIN covered ON covered.doc_id = words.doc_id AND covered.at = words.p
    ), joined AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM kept GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
           sha256(coalesce(t, '')) AS kept_sha256
    FROM words LEFT JOIN joined USING (doc_id)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op6_pigeonhole_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op7_context_tree_scores")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.weighted_with_base(context_tree.score(documents(spark, sf_dir)))


@query("op8_spherical_cap_filters")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )
    return counted.drop("text")


@query("op10_pigeonring_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op13_contour_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


@query(
    "op11_reply_tree_chats",
    r"""
    WITH rows AS (
        SELECT conv_id, turn, role, text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
    ), turns AS (
        SELECT conv_id, coalesce(role, '') AS said_by, coalesce(text, '') AS said,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
        FROM rows
    ), escaped AS (
        SELECT *, regexp_replace(said, '(<)(\\*/?s>)|(\[)(\\*(?:/?SYS|/?INST|/?ROLE|END)\])', '\1\3\\\2\4', 'g') AS e,
               regexp_replace(said_by, '(<)(\\*/?s>)|(\[)(\\*(?:/?SYS|/?INST|/?ROLE|END)\])', '\1\3\\\2\4', 'g') AS r
        FROM turns
    )
    SELECT conv_id, count(*)::BIGINT AS n_turns,
           sha256(string_agg(said_by || chr(10) || said || chr(10), '' ORDER BY place)) AS turns_sha256,
           coalesce(sum(length(said)) FILTER (said_by = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(said, '' ORDER BY place) FILTER (said_by = 'assistant'), '')) AS loss_sha256,
           sum(length(e) + CASE said_by WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                                        ELSE 18 + length(r) END)::BIGINT AS formatted_chars
    FROM escaped GROUP BY conv_id
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{said}'), (-1L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").union(more)
    found = chats.conversations(chats.chains(rows))
    turns = F.transform(chats.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = chats.read_masked(F.col("formatted"), F.col("loss"))
    found = found.select("tree_id", "formatted", turns.alias("turns"), masked.alias("masked"))
    return found.select(
        F.col("tree_id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", "").cast("binary"), 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2(F.col("masked").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query(
    "op12_hat_trie_phrases",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), words AS (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
    ), totals AS (
        SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
    ), grams AS (
        SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS g, count(*)::BIGINT AS f
        FROM words, (VALUES (1), (2), (3)) AS s(k), LATERAL unnest(range(1, len(w) - k + 2)) AS r(i)
        GROUP BY ALL HAVING count(*) >= 10
    ), parted AS (
        SELECT g.lang, g.g, g.f AS a, c.k AS cut, array_to_string(string_split(g.g, ' ')[1 : c.k], ' ') AS head,
               array_to_string(string_split(g.g, ' ')[c.k + 1 : g.k], ' ') AS rest
        FROM grams AS g JOIN (VALUES (1), (2)) AS c(k) ON g.k > c.k
    ), cuts AS (
        SELECT p.lang, p.g, p.a, p.cut, l.f AS l, r.f AS r, ((1000000::HUGEINT * p.a * p.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
        FROM parted AS p JOIN grams AS l ON l.lang = p.lang AND l.g = p.head JOIN grams AS r ON r.lang = p.lang AND r.g = p.rest
    ), best AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
    ), inner_pairs AS (
        SELECT lang, array_to_string(string_split(g, ' ')[p : p + 1], ' ') AS g, max(f) AS longer
        FROM grams, (VALUES (1), (2)) AS o(p) WHERE k = 3 GROUP BY ALL
    ), kept AS (
        SELECT best.* FROM best LEFT JOIN inner_pairs AS i ON i.lang = best.lang AND i.g = best.g
        WHERE 100 * coalesce(longer, 0) < 50 * a
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g))::BIGINT AS rank,
           g AS phrase, a, l, r, n, score
    FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
