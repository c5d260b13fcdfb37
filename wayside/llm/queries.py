"""The registered query of each operator of this package, and SQL where SQL can say the same.

A query applies its operator with production parameters to the whole of its table and
derives the agreed columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def keep(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query("op4_prefix_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wayside.llm import prefix_tokens

    return prefix_tokens.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@_query("op3_offset_pieces")
def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wayside.llm import pieces

    return pieces.digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


# The SQL compares every query with every vector; the codes' error bounds are wide enough
# for the search to return the same.
@_query(
    "op6_one_bit_neighbours",
    """
    WITH usable AS (
        SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               list_reduce(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]), lambda a, b: a + b, 0.0::DOUBLE) AS score
        FROM usable q JOIN usable c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
    ), ranked AS (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
)
def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wayside.llm import one_bit

    vectors = table(spark, sf_dir, "embeddings")
    return one_bit.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def _crc(divisor: int):
    """Remainder by which rows are held out; null for a row without an id."""
    from pyspark.sql import functions as F

    return F.crc32(F.col("doc_id").cast("string")) % divisor


@_query("op8_subword_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from wayside.llm import subword

    documents = table(spark, sf_dir, "documents")
    model = subword.learn(subword.labelled(documents, table(spark, sf_dir, "labels"), _crc(4) != 2))
    return subword.score(documents, model).select(
        "doc_id",
        F.coalesce(_crc(4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= subword.THRESHOLD).cast("int").alias("predicted"),
    )


@_query("op10_rank_order_language")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from wayside.llm import language

    documents = table(spark, sf_dir, "documents")
    learned = language.profiles(documents.where(_crc(5) != 0))
    return language.identify(documents, learned).select(
        "doc_id", F.coalesce(_crc(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@_query(
    "op5_chosen_path_duplicates",
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE
            WHEN len(w) = 0 THEN []
            WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
        FROM words
    ), shingles AS (
        SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
    ), links AS (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
    ), reach AS (
        SELECT doc_id AS a, doc_id AS b FROM sets
        UNION
        SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    ), smallest AS (
        SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
    )
    SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM sets JOIN smallest USING (doc_id)
    """,
)
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wayside.llm import chosen_path

    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, num=85)


@_query("op9_rare_seed_leaks")
def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wayside.llm import leaks

    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _license_sql() -> str:
    from wayside.llm import licences

    return licences.scan_sql()


@_query("op7_diagonal_licenses", _license_sql())
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wayside.llm import licences

    return licences.scan(table(spark, sf_dir, "documents"))


@_query("op2_skip_chain_private")
def private(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wayside.llm import skip_chain

    documents = table(spark, sf_dir, "documents")
    return skip_chain.digests(skip_chain.spans(documents, skip_chain.learn(documents)))


@_query("op1_compact_window_repeats")
def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wayside.llm import compact

    return compact.repeats(table(spark, sf_dir, "documents"))


def _collocation_sql() -> str:
    from wayside.llm import collocations

    return collocations.collocations_sql()


@_query("op13_stream_collocations", _collocation_sql())
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wayside.llm import collocations

    return collocations.collocations(table(spark, sf_dir, "documents"))


@_query("op12_trie_pair_spellings")
def spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wayside.llm import spellings

    return spellings.variants(table(spark, sf_dir, "documents"))


@_query("op11_zstd_novelty_secrets")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wayside.llm import novelty

    documents = table(spark, sf_dir, "documents")
    return novelty.digests(novelty.spans(documents, novelty.identifiers(documents)))
