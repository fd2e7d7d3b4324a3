"""The registered queries of the operators: thin callers with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sifter.llm.centroids import cluster_vectors
from sifter.llm.common import read_table
from sifter.llm.decontam import contamination, find_matches
from sifter.llm.line_dedup import dedup_lines
from sifter.llm.lm import score_documents
from sifter.llm.packing import pack_documents
from sifter.llm.prefix_trie import prefix_trie
from sifter.llm.secrets import find_secrets
from sifter.llm.sharding import assign_shards
from sifter.llm.simhash import near_duplicates
from sifter.llm.token_counts import count_tokens
from sifter.llm.token_files import token_index
from sifter.llm.topk import top_k
from sifter.llm.toxicity import classify

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, tokens and log-probability of every whole text under the unigram pieces."""
    return count_tokens(read_table(spark, sf_dir, "documents"))


@register
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of eight, its slot there and its shard of nine (law ``key``)."""
    return assign_shards(read_table(spark, sf_dir, "documents"), shards=8)


@register
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity from classifiers trained on confirmed toxic and unlabelled text."""
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text as rANS-coded ids, read back from the files."""
    return token_index(read_table(spark, sf_dir, "documents"))


@register
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the later copies of line runs of 50 words or more."""
    return dedup_lines(read_table(spark, sf_dir, "documents"), min_words=50).select("doc_id", "text", "n_lines_dropped")


@register
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 ids along the Hilbert curve: one row per piece."""
    return pack_documents(read_table(spark, sf_dir, "documents"), with_ids=False)


@register
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best whole inner products of every twentieth vector with all others."""
    return top_k(read_table(spark, sf_dir, "embeddings"))


ORACLE["op7_topk"] = """
WITH w AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND list_count(embedding) = len(embedding)
             AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM w q JOIN w c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@register
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint of three-word shingles and its component at three bits."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, distance=3)


@register
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's benchmark words by windows of ten."""
    return contamination(find_matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


@register
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's unigram score and attention-model score."""
    return score_documents(read_table(spark, sf_dir, "documents"))


ORACLE["op9_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
widths AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, widths WHERE len(w) >= n)),
m AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@register
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's centroid of eight after ten rounds, by bisector tournament."""
    return cluster_vectors(read_table(spark, sf_dir, "embeddings"))


def _centroid_sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """The rounds written out: c<i> has the centroids after i rounds, a<i> the vectors with key distance * k + number."""
    ctes = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
                 FROM embeddings WHERE len(embedding) = {dims} AND list_count(embedding) = {dims}
                   AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0)""",
            f"""c0 AS MATERIALIZED (SELECT num, v FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS num, v
                 FROM v) WHERE num < {k})"""]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT rid, min(CAST(list_inner_product(v.v, v.v) - 2 * list_inner_product(v.v, c.v)
                 + list_inner_product(c.v, c.v) AS BIGINT) * {k} + num) AS key FROM v CROSS JOIN c{i} c GROUP BY rid)""")
        if i < rounds:
            ctes.append(f"""s{i} AS (SELECT num, list(CAST(q AS DOUBLE) ORDER BY d) AS v FROM (
                 SELECT key % {k} AS num, d, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS q
                 FROM (SELECT key, unnest(range({dims})) AS d, CAST(unnest(v) AS BIGINT) AS x FROM a{i} JOIN v USING (rid)) GROUP BY ALL) GROUP BY num)""")
            ctes.append(f"c{i + 1} AS MATERIALIZED (SELECT c.num, coalesce(s.v, c.v) AS v FROM c{i} c LEFT JOIN s{i} s ON s.num = c.num)")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, CAST(key % {k} AS INTEGER) AS cluster, CAST(key // {k} AS BIGINT) AS distance,
       CAST(sum(key // {k}) OVER (PARTITION BY key % {k}) AS BIGINT) AS cluster_inertia, CAST(sum(key // {k}) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c.v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} c ON c.num = key % {k}"""


ORACLE["op11_centroids"] = _centroid_sql()


@register
def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's secrets: spans of the fixed patterns and those that zstandard finds novel."""
    return find_secrets(read_table(spark, sf_dir, "documents")).drop("secrets")


@register
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


# CRC-32 of a decimal number: eight shifts for each of its characters.
_CRC_BYTE = ("list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))")
_CRC = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))), "
        f"lambda a, s: list_transform([xor(a, s)], lambda b: {_CRC_BYTE})[1]), 4294967295)")

ORACLE["op13_prefix_trie"] = f"""
WITH own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns,
                    CAST({_CRC} % 6 AS BIGINT) AS h
             FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
reb AS (SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
        FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
pre AS (SELECT conv_id, len(turns) AS size, d, turns[1:d] AS node FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM reb)),
n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, list(conv_id ORDER BY conv_id) FILTER (size = d) AS ends
      FROM pre GROUP BY node, d),
k AS (SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL),
w AS (SELECT n.*, coalesce(kids, 0) AS kids, (n_convs - 1) * CASE WHEN n.d > 0 THEN length(n.node[n.d].x) ELSE 0 END AS saved
      FROM n LEFT JOIN k ON k.d = n.d AND k.node = n.node),
up AS (SELECT node[1:a] AS node, a AS d, sum(saved) AS saved, count(*) FILTER (kids = 0) AS leaves
       FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM w) GROUP BY ALL)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.kids AS n_children, up.leaves AS n_leaves,
       CAST(up.saved AS BIGINT) AS saved_tokens, sha256(coalesce(array_to_string(w.ends, ','), '')) AS ends_sha256
FROM w JOIN up ON up.d = w.d AND up.node = w.node LEFT JOIN n p ON p.d = w.d - 1 AND p.node = w.node[1:w.d - 1]
"""
