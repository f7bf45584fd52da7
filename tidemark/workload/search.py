"""Text vectors and similarity queries."""

from pyspark.sql import functions as F

from tidemark.functions import vectors
from tidemark.operators import similarity, textvec
from tidemark.session import durable
from tidemark.workload.registry import query

STOP_WORDS = (
    "the", "and", "of", "in", "to", "is", "that", "for", "on", "as",
    "le", "la", "de", "et", "un", "une", "der", "die", "und", "el",
)
STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)


def vocabulary_sql(size):
    return f"""toks AS (
    SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE term NOT IN ({STOP_SQL}) GROUP BY ALL),
best AS (SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS documents FROM tf GROUP BY term
         ORDER BY total DESC, term LIMIT {size}),
vocab AS (SELECT row_number() OVER (ORDER BY term) - 1 AS dimension, term, total, documents,
                 ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + documents)) + 1 AS idf FROM best)"""


def weights_sql(size):
    return f"""{vocabulary_sql(size)},
raw AS (SELECT doc_id, dimension, term, tf * idf AS w FROM tf JOIN vocab USING (term)),
weights AS (SELECT doc_id, dimension, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM raw)"""


def vocabulary(t, size):
    return textvec.fit_vocabulary(t.spread("documents"), "text", size, STOP_WORDS)


@query(
    "tfidf_vocab",
    f"WITH {vocabulary_sql(384)} SELECT dimension, term, total, documents, round(idf, 9) AS idf FROM vocab",
)
def tfidf_vocab(t):
    table = vocabulary(t, 384).table(t.spark)
    return table.withColumn("idf", F.round("idf", 9))


@query(
    "tfidf_weights",
    f"WITH {weights_sql(384)} SELECT doc_id, dimension, round(w, 9) AS weight FROM weights",
)
def tfidf_weights(t):
    vocab = vocabulary(t, 384)
    entries = t.spread("documents").select("doc_id", F.explode(vocab.sparse(F.col("text"))).alias("x"))
    return entries.select(
        "doc_id", F.col("x.i").cast("long").alias("dimension"), F.round("x.w", 9).alias("weight")
    )


QUERY_SQL = f"""{weights_sql(384)},
asked AS (SELECT term, count(*) AS tf FROM (SELECT unnest(regexp_extract_all(lower(text),
              '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM benchmark WHERE item_id = 0) GROUP BY term),
query AS (SELECT dimension, w / sqrt(sum(w * w) OVER ()) AS q
          FROM (SELECT dimension, tf * idf AS w FROM asked JOIN vocab USING (term))),
scored AS (SELECT doc_id, sum(w * q) AS score FROM weights JOIN query USING (dimension) GROUP BY doc_id)"""


def asked(t, vocab):
    text = t.benchmark.filter("item_id = 0").select("text").first().text
    return vocab.embed(t.spark, text)


@query(
    "tfidf_search",
    f"""WITH {QUERY_SQL} SELECT doc_id, lang, round_even(coalesce(score, 0), 4) AS similarity_score
        FROM documents LEFT JOIN scored USING (doc_id) ORDER BY similarity_score DESC, doc_id LIMIT 10""",
)
def tfidf_search(t):
    vocab = vocabulary(t, 384)
    score = textvec.sparse_score(vocab.sparse(F.col("text")), asked(t, vocab))
    return similarity.search(t.spread("documents"), "doc_id", score, 10).select("doc_id", "lang", "similarity_score")


@query(
    "hybrid_search",
    f"""WITH {QUERY_SQL} SELECT doc_id, source, round_even(coalesce(score, 0), 4) AS similarity_score
        FROM documents LEFT JOIN scored USING (doc_id) WHERE lang = 'en' AND n_chars >= 300 AND n_chars <= 9000
        ORDER BY similarity_score DESC, doc_id LIMIT 5""",
)
def hybrid_search(t):
    vocab = vocabulary(t, 384)
    score = textvec.sparse_score(vocab.sparse(F.col("text")), asked(t, vocab))
    found = similarity.hybrid_search(
        t.spread("documents"), "doc_id", score, equals={"lang": "en", "source": None},
        at_least={"n_chars": 300}, at_most={"n_chars": 9000},
    )
    return found.select("doc_id", "source", "similarity_score")


@query(
    "hybrid_filter_only",
    """SELECT doc_id, source, CAST(NULL AS DOUBLE) AS similarity_score FROM documents
       WHERE lang = 'de' ORDER BY doc_id LIMIT 5""",
)
def hybrid_filter_only(t):
    found = similarity.hybrid_search(t.documents, "doc_id", None, equals={"lang": "de"})
    return found.select("doc_id", "source", "similarity_score")


@query(
    "vector_topk",
    """SELECT vec_id, label, round_even(list_cosine_similarity(CAST(embedding AS DOUBLE[]),
                 (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 4) AS similarity_score
       FROM embeddings ORDER BY similarity_score DESC, vec_id LIMIT 10""",
)
def vector_topk(t):
    wanted = t.embeddings.filter("vec_id = 0").select("embedding").first().embedding
    found = similarity.search_vector(t.embeddings, "vec_id", "embedding", wanted, 10)
    return found.select("vec_id", "label", "similarity_score")


@query(
    "vector_neighbours",
    """SELECT vec_id, string_agg(other, ', ' ORDER BY score DESC, other_id) AS top_similar FROM (
           SELECT a.vec_id, b.vec_id AS other_id, CAST(b.vec_id AS VARCHAR) AS other,
                  round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 10) AS score
           FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
           QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY score DESC, b.vec_id) <= 3)
       GROUP BY vec_id""",
)
def vector_neighbours(t):
    near = similarity.nearest_neighbours(t.embeddings, "vec_id", "embedding", 3)
    return similarity.neighbour_text(near, "vec_id")


@query(
    "vector_recall",
    """SELECT CAST(3 * count(*) AS BIGINT) AS asked, TRUE AS reached, TRUE AS scores_agree FROM embeddings""",
)
def vector_recall(t):
    """Approximate neighbours of all vectors next to the exact ones: nine in ten are found, and
    the score of each is the cosine of the two vectors."""
    found = durable(similarity.nearest_approximate(t.embeddings, "vec_id", "embedding", 3), "found")
    exact = similarity.nearest_neighbours(t.embeddings, "vec_id", "embedding", 3)
    one = t.embeddings.select("vec_id", F.col("embedding").alias("_a"))
    other = t.embeddings.select(F.col("vec_id").alias("neighbour"), F.col("embedding").alias("_b"))
    pairs = found.join(one, "vec_id").join(other, "neighbour")
    off = F.abs(F.col("score") - vectors.cosine(F.col("_a"), F.col("_b")))
    furthest = pairs.agg(F.max(off)).first()[0] or 0.0
    measured = similarity.recall(found, exact, "vec_id")
    return measured.select(
        "asked", (F.col("recall") >= 0.9).alias("reached"), F.lit(furthest < 1e-6).alias("scores_agree")
    )


@query(
    "enriched_export",
    f"""WITH {weights_sql(384)},
dense AS (SELECT doc_id, list(coalesce(w, 0) ORDER BY dimension) AS v
          FROM documents CROSS JOIN vocab LEFT JOIN weights USING (doc_id, dimension) GROUP BY doc_id),
near AS (SELECT a.doc_id, b.doc_id AS other, round(list_dot_product(a.v, b.v), 10) AS score
         FROM dense a JOIN dense b ON a.doc_id <> b.doc_id
         QUALIFY row_number() OVER (PARTITION BY a.doc_id ORDER BY score DESC, b.doc_id) <= 3),
texts AS (SELECT doc_id, string_agg(CAST(other AS VARCHAR), ', ' ORDER BY score DESC, other) AS top_similar FROM near GROUP BY 1)
SELECT doc_id, source, top_similar, array_to_string(list_transform(v[1:16], lambda x: printf('%.4f', round_even(x, 4))), ' ') AS embedding
FROM documents JOIN labels USING (doc_id) JOIN dense USING (doc_id) JOIN texts USING (doc_id)
WHERE quality = 1 AND toxic = 0""",
)
def enriched_export(t):
    vocab = vocabulary(t, 384)
    dense = t.spread("documents").select("doc_id", "source", vocab.dense(vocab.sparse(F.col("text"))).alias("v"))
    # three readers: the search, its members and the export
    dense = durable(dense, "dense")
    near = similarity.neighbour_text(similarity.nearest_neighbours(dense, "doc_id", "v", 3), "doc_id")
    good = t.labels.filter("quality = 1 AND toxic = 0").select("doc_id")
    shown = F.transform(vectors.prefix(F.col("v")), lambda x: F.format_string("%.4f", x))
    return (
        dense.join(good, "doc_id").join(near, "doc_id")
        .select("doc_id", "source", "top_similar", F.array_join(shown, " ").alias("embedding"))
    )
