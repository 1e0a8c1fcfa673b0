"""One registered query for each operator, over whole tables, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropweave.llm import byte_bpe, coded_ids, conversations, decontamination, knn_join, packing, passages, personal, repeated_bytes, simhash, token_counts, toxicity, vector_codes
from cropweave.llm.shipping import ship
from cropweave.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@register
def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share near-duplicate passages of 50 words or more."""
    return passages.duplicate_passages(table(spark, sf_dir, "documents"), shared_folder(spark), words=50, similarity=0.8)


@register
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the base patterns and what the field adds."""
    return personal.personal_data(table(spark, sf_dir, "documents"), shared_folder(spark))


@register
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose fingerprints of 4-word shingles differ in at most 4 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shared_folder(spark), words=4, distance=4)


@register
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that aren't held out."""
    docs, labels = (table(spark, sf_dir, x) for x in ("documents", "labels"))
    return toxicity.toxicity_scores(docs, labels, shared_folder(spark))


@register
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by rank-synchronous merging."""
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, tokenizer("byte_bpe_50k.json"), pattern(), limit=512)


@register
def op6_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that start anywhere else."""
    return repeated_bytes.without_repeats(table(spark, sf_dir, "documents"), shared_folder(spark), length=400)


@register
def op7_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 rows of largest inner product for every 50th vector."""
    return knn_join.top_k(table(spark, sf_dir, "embeddings"), shared_folder(spark), every=50, k=5)


ORACLES["op7_knn_join"] = """
WITH kept AS (
    SELECT vec_id, MIN([CAST(FLOOR(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND LEN(embedding) > 0
      AND LEN([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = LEN(embedding)
    GROUP BY vec_id
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
    FROM kept q JOIN kept c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND LEN(q.v) = LEN(c.v)
), ranked AS (
    SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@register
def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written as directly addressable codes and read back."""
    path = coded_ids.new_file(shared_folder(spark))
    coded_ids.write_ids(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"), end_id=2)
    return coded_ids.read_ids(spark, path)


@register
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the transducer, and what they decode to."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"), pattern())


@register
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 10-word windows of benchmark items."""
    docs, items = (table(spark, sf_dir, x) for x in ("documents", "benchmark"))
    return decontamination.contamination(docs, items, shared_folder(spark), window=10)

ORACLES["op10_decontamination"] = r"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), phrases AS MATERIALIZED (
    SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS phrase
    FROM (SELECT item_id, w, LEAST(LEN(w), 10) AS n, unnest(range(1, GREATEST(LEN(w) - 10, 0) + 2)) AS i FROM items WHERE LEN(w) > 0)
), places AS (
    SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase
    FROM (SELECT r, w, n, unnest(range(1, LEN(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM phrases) WHERE LEN(w) >= n)
), found AS MATERIALIZED (
    SELECT r, n, i, item_id FROM places JOIN phrases USING (n, phrase)
), hits AS (
    SELECT r, COUNT(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM found) GROUP BY r
), named AS (
    SELECT r, COUNT(*) AS n_items, sha256(string_agg(name, ',' ORDER BY name)) AS items_sha256
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(LEN(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
       COALESCE(items_sha256, sha256('')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""


@register
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the damage of the contract."""
    repair = conversations.Repair(conversations.damaged(table(spark, sf_dir, "conversations")), shared_folder(spark))
    summary, digests = repair.summary(), repair.digests().withColumnRenamed("conv_id", "own")
    return summary.join(digests, summary["conv_id"].eqNullSafe(digests["own"])).drop("own")


#: Costs, edits and repaired text of what follows a row, for the four grammar states, built up from the last row.
ORACLES["op11_conversations"] = r"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
           flatten([[(ascii(c) >> k) & 1 FOR k IN range(8)] FOR c IN
                    string_split(COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' '), '')]) AS bits
    FROM conversations
), kinds AS (
    SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(b AS BIGINT) FOR b IN bits]),
        LAMBDA c, b: xor(c >> 1, CASE WHEN c & 1 <> b THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END)), CAST(4294967295 AS BIGINT)) % 20 AS kind
    FROM named
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM kinds, range(2) AS r(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(CAST(LENGTH(role) AS VARCHAR) || ':' || role || text)) AS i
    FROM damaged
), marked AS MATERIALIZED (
    SELECT *, role[1] AS initial, LAG(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS initial_before,
           CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
    FROM placed
), counted AS MATERIALIZED (
    SELECT conv_id, COUNT(*) AS n, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps,
           COUNT(*) FILTER (fault = 'blank') AS blank, COUNT(*) FILTER (fault = 'duplicate') AS duplicate,
           COUNT(*) FILTER (fault = 'truncated') AS truncated,
           COUNT(*) FILTER (i > 1 AND initial_before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
), walk AS (
    SELECT o.conv_id, COALESCE(n, 0) + 1 AS i,
           {'c': CAST(0 AS BIGINT), 'a': '', 't': ''} AS s0, {'c': CAST(10 AS BIGINT), 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS s1,
           {'c': CAST(5 AS BIGINT), 'a': 'I', 't': chr(10) || 'assistant:'} AS s2, {'c': CAST(0 AS BIGINT), 'a': '', 't': ''} AS s3
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
    UNION ALL
    SELECT conv_id, i,
           list_min([b0, {'c': x2.c + 5, 'a': 'I' || x2.a, 't': chr(10) || 'user:' || x2.t}]),
           list_min([b1, {'c': x2.c + 5, 'a': 'I' || x2.a, 't': chr(10) || 'user:' || x2.t}]),
           x2, list_min([b3, {'c': b2.c + 5, 'a': 'I' || b2.a, 't': chr(10) || 'user:' || b2.t}])
    FROM (SELECT *, list_min([b2, {'c': b3.c + 5, 'a': 'I' || b3.a, 't': chr(10) || 'assistant:' || b3.t}]) AS x2 FROM (
        SELECT r.conv_id, r.i,
               list_min(list_filter([d0, u, CASE initial WHEN 's' THEN k1 WHEN 'u' THEN k2 END], LAMBDA x: x IS NOT NULL)) AS b0,
               list_min(list_filter([d1, u, CASE initial WHEN 'u' THEN k2 END], LAMBDA x: x IS NOT NULL)) AS b1,
               list_min(list_filter([d2, v, CASE initial WHEN 'a' THEN k3 END], LAMBDA x: x IS NOT NULL)) AS b2,
               list_min(list_filter([d3, u, CASE initial WHEN 'u' THEN k2 END], LAMBDA x: x IS NOT NULL)) AS b3
        FROM (
            SELECT m.conv_id, m.i, m.initial,
                   {'c': s0.c + 2, 'a': 'D' || s0.a, 't': s0.t} AS d0, {'c': s1.c + 2, 'a': 'D' || s1.a, 't': s1.t} AS d1,
                   {'c': s2.c + 2, 'a': 'D' || s2.a, 't': s2.t} AS d2, {'c': s3.c + 2, 'a': 'D' || s3.a, 't': s3.t} AS d3,
                   CASE WHEN kept THEN {'c': s2.c + 1 + extra, 'a': 'R' || s2.a, 't': chr(10) || 'user:' || text || s2.t} END AS u,
                   CASE WHEN kept THEN {'c': s3.c + 1 + extra, 'a': 'R' || s3.a, 't': chr(10) || 'assistant:' || text || s3.t} END AS v,
                   CASE WHEN kept THEN {'c': s1.c + extra, 'a': 'K' || s1.a, 't': chr(10) || role || ':' || text || s1.t} END AS k1,
                   CASE WHEN kept THEN {'c': s2.c + extra, 'a': 'K' || s2.a, 't': chr(10) || role || ':' || text || s2.t} END AS k2,
                   CASE WHEN kept THEN {'c': s3.c + extra, 'a': 'K' || s3.a, 't': chr(10) || role || ':' || text || s3.t} END AS k3
            FROM walk w JOIN (SELECT *, fault IN ('', 'truncated') AS kept, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra FROM marked) m
              ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i - 1
        ) r
    ))
)
SELECT w.conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
       COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, s0.c AS cost, s0.a AS audit, sha256(substr(s0.t, 2)) AS repaired_sha256
FROM walk w LEFT JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id WHERE w.i = 1
"""


@register
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2048 ids."""
    path = tokenizer("byte_bpe_50k.json")
    pieces = packing.pack(table(spark, sf_dir, "documents"), shared_folder(spark), path, pattern(), end_id=0, capacity=2048)
    return pieces.drop("ids")


@register
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code of four entries for every vector after four Lloyd rounds."""
    rows, codebooks = vector_codes.compress(table(spark, sf_dir, "embeddings"), shared_folder(spark), parts=4, entries=256, rounds=4, scale=1024)
    coded = vector_codes.label_errors(rows)
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codebooks.digest()).alias("codebooks_sha256"))


def _vector_codes_sql() -> str:
    """Lloyd rounds unrolled: ``book0`` holds the first entries, ``at0`` the nearest entry of every part, and so on."""
    steps = """
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, [CAST(FLOOR(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v,
           row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row
    FROM embeddings
    WHERE LEN(embedding) > 0 AND LEN([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = LEN(embedding)
), parts AS MATERIALIZED (
    SELECT row, part, v[part * (LEN(v) // 4) + 1 : (part + 1) * (LEN(v) // 4)] AS p FROM kept, range(4) AS t(part)
), book0 AS MATERIALIZED (
    SELECT part, row - 1 AS entry, p AS c FROM parts WHERE row <= 256
)"""
    for k in range(5):
        steps += f""", at{k} AS MATERIALIZED (
    SELECT row, part, MIN({{'d': CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(p, c)]) AS BIGINT), 'e': entry}}) AS best
    FROM parts JOIN book{k} USING (part) GROUP BY ALL
)"""
        if k < 4:
            steps += f""", book{k + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, COALESCE(m.c, b.c) AS c
    FROM book{k} b LEFT JOIN (
        SELECT part, entry, list(CAST(FLOOR(s / n) AS BIGINT) ORDER BY place) AS c
        FROM (SELECT part, a.best.e AS entry, place, SUM(p[place]) AS s, COUNT(*) AS n
              FROM at{k} a JOIN parts USING (row, part), range(1, 17) AS t(place) GROUP BY ALL)
        GROUP BY ALL) m ON m.part = b.part AND m.entry = b.entry
)"""
    return steps + """, coded AS (
    SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(SUM(best.d) AS BIGINT) AS error
    FROM at4 GROUP BY row
)
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM book4) AS codebooks_sha256
FROM coded JOIN kept USING (row)
"""


ORACLES["op13_vector_codes"] = _vector_codes_sql()
