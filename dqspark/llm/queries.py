"""The queries of this subpackage, and the same results as SQL where SQL has a way to say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqspark.llm import (
    decontaminate,
    embeddings,
    masked_lm,
    mixing,
    packing,
    pii,
    quality,
    secrets,
    sharding,
    simhash,
    spelling,
    urls,
    whitening,
)
from dqspark.llm.common import given


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(given(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [kind.name for kind in pii.BASE]

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def of_kinds(*kinds):
        return F.filter("pii", lambda s: s["kind"].isin(*kinds))

    counts = {f"n_{kind}": F.size(of_kinds(kind)).cast("long") for kind in base}
    digests = {"base_sha256": F.sha2(joined(of_kinds(*base)), 256), "spans": joined(F.col("pii"))}
    return found.select("doc_id", *[c.alias(n) for n, c in (counts | digests).items()])


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(given(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "share")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.scores(given(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(given(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, distance=4).select(
        "doc_id", "fingerprint", "component_id"
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(given(spark, sf_dir, "documents").select("doc_id", "text"), shards=24)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, given(spark, sf_dir, "labels"))
    held_out = quality.held_out(F.col("doc_id")).alias("held_out")
    return quality.scored(docs, model).select("doc_id", held_out, "score", "predicted")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(given(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = (F.col("size") * F.size("shards")).alias("taken")
    return planned.select("doc_id", "size", "source_size", "target", taken, "shards")


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(given(spark, sf_dir, "embeddings"))


#: Host, path and verdict, as the contract states them.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {listed} AS rules(host, path, verdict)")
    judged = urls.judge(given(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(given(spark, sf_dir, "embeddings"), "vec_id", "embedding", components=16)
    measured = [F.col(c) for c in ("n", "deviation", "explained", "identity_error")]
    placed = white.select("id", *measured, F.posexplode("whitened").alias("at", "whitened"))
    component = F.col("at") + 1
    return placed.select(
        F.col("id").alias("vec_id"),
        component.cast("int").alias("component"),
        "n",
        "deviation",
        "whitened",
        F.element_at("explained", component).alias("explained"),
        "identity_error",
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    return spelling.variants(spelling.vocabulary(docs, "doc_id", "text", typo_every=97, shortest=5, fewest=3))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # where the vocabulary files lie; needed by this query alone

    pieces = packing.pack(given(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), window=2048, end=1)
    return pieces.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_pii,
        op2_secrets,
        op3_decontamination,
        op4_lm_scoring,
        op5_simhash,
        op6_sharding,
        op7_quality,
        op8_mixing,
        op9_embeddings,
        op10_urls,
        op11_whitening,
        op12_spelling,
        op13_packing,
    )
}

_FITS = "(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}')"
_BY_LENGTH = sorted(RULES, key=lambda r: -len(r[0] + r[1]))


def _case(value: Callable[[tuple[str, str, str]], str], default: str) -> str:
    whens = " ".join(f"WHEN {_FITS.format(host=r[0], path=r[1])} THEN '{value(r)}'" for r in _BY_LENGTH)
    return f"CASE {whens} ELSE {default} END"


#: CRC-32 of a list of bytes, by its table of 256 remainders.
_CRC = """
    xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes}),
        lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)
"""

ORACLES: dict[str, str] = {
    "op12_spelling": f"""
        WITH RECURSIVE crc AS (
            SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, _:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)
        ), runs AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM documents
        ), keyed AS (
            SELECT run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x
            FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run
        ), hashed AS (
            SELECT run, n, {_CRC.format(
                bytes="list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT)", table="t"
            )} AS h
            FROM keyed, crc
        ), typed AS (
            SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word, n FROM hashed
        ), words AS (
            SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
        ), cuts AS (
            SELECT word, n, left(word, i) AS a, substr(word, i + 2) AS b FROM words, range(30000) r(i) WHERE i < length(word)
        ), pairs AS (
            SELECT c.word, d.word AS near, d.n AS near_n FROM cuts c JOIN cuts d ON c.a = d.a AND c.b = d.b AND c.word <> d.word
            UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.a || c.b = w.word
            UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.a || c.b = w.word
        ), best AS (
            SELECT w.word, w.n, count(p.near) AS n_near, (list(p.near ORDER BY p.near_n DESC, p.near))[1] AS near,
                max(p.near_n) AS near_n
            FROM words w LEFT JOIN pairs p ON p.word = w.word GROUP BY w.word, w.n
        ), formed AS (
            SELECT word, n, n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
                CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
            FROM best
        ), way AS (
            SELECT word, word AS root FROM formed
            UNION ALL SELECT w.word, f.form FROM way w JOIN formed f ON f.word = w.root WHERE f.form IS NOT NULL
        )
        SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM formed f JOIN way w ON w.word = f.word
        WHERE NOT EXISTS (SELECT 1 FROM formed g WHERE g.word = w.root AND g.form IS NOT NULL)
    """,
    "op9_embeddings": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.95
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM v
            UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
        )
        SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id) AS n_links,
            min(r.b) AS component_id, v.vec_id = min(r.b) AS kept
        FROM v JOIN reach r ON r.a = v.vec_id GROUP BY v.vec_id
    """,
    "op10_urls": f"""
        WITH parts AS (
            SELECT page_id,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        )
        SELECT page_id, host, path, {_case(lambda r: r[0] + r[1], "NULL")} AS rule,
            {_case(lambda r: r[2], "'allow'")} AS verdict
        FROM parts
    """,
}
