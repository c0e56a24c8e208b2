"""The operators of this subpackage applied to the stored tables.

Each query runs its operator with production parameters over a whole table
and derives the digest columns of its contract. ``ORACLES`` has DuckDB SQL
where SQL can say the same; the others are tested against brute force in
``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import read_table
from quarry.llm.conversations import conversation_hashes, damaged, repair_conversations
from quarry.llm.encoding import public_path
from quarry.llm.fingerprints import compare_with_next, lexicon
from quarry.llm.jaccard import jaccard_components
from quarry.llm.licenses import all_templates, scan_licenses
from quarry.llm.lines import dedup_lines
from quarry.llm.mixing import mix_sources
from quarry.llm.packing import pack_documents
from quarry.llm.phrases import collocations, top_phrases
from quarry.llm.ppm import score_language
from quarry.llm.private_data import KINDS, private_spans, span_list
from quarry.llm.quality import score_quality
from quarry.llm.token_files import read_token_files, token_folder, write_token_files
from quarry.llm.topk import exact_top_k

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return deco


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*cols)


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (
    SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_BLANKS}) AS key FROM lines),
often AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, o.key IS NOT NULL AS gone FROM keyed k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more are dropped everywhere."""
    return dedup_lines(documents(spark, sf_dir, "doc_id", "text"), min_docs=10, min_chars=1) \
        .select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices and whole license texts in all documents: a row for each document and template."""
    return scan_licenses(documents(spark, sf_dir, "doc_id", "text"), all_templates(spark))


@query()
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, and whether it is kept."""
    return score_quality(documents(spark, sf_dir, "doc_id", "text")).drop("text")


@query()
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of 2048 tokens."""
    return pack_documents(documents(spark, sf_dir, "doc_id", "text"), public_path(), capacity=2048, end_id=0) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query(r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           (('0x' || substr(md5('7:' || doc_id || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u,
           length(coalesce(text, '')) AS n,
           length(regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}\s.,;:''"()?-]+', '', 'g')) AS plain
    FROM documents),
keyed AS (
    SELECT doc_id, source, size,
           1 - pow(u, 1 / CASE WHEN n > 0 THEN greatest(0.25, 1 - 1.5::DOUBLE * (n - plain) / n) ELSE 1.0 END::DOUBLE) AS key
    FROM sized),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
    FROM keyed GROUP BY source),
levels AS (
    SELECT *, 2.0::DOUBLE * source_size AS cap,
           (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0))
               / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
    FROM sources
    WINDOW before AS (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
    SELECT source, source_size, least(cap, w * (SELECT arg_min(level, cap / w) FROM levels WHERE level <= cap / w)) AS target FROM levels),
rests AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
           target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS rest FROM targets),
running AS (
    SELECT k.*, r.source_size, r.target, r.epochs, r.rest,
           sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS UNBOUNDED PRECEDING) AS upto
    FROM keyed k JOIN rests r ON k.source IS NOT DISTINCT FROM r.source),
gaps AS (SELECT source, any_value(rest) - coalesce(sum(size) FILTER (WHERE upto <= rest), 0) AS gap FROM running GROUP BY source),
closing AS (
    SELECT r.source, arg_min(r.doc_id, (abs(r.size - g.gap), r.key)) AS doc_id
    FROM running r JOIN gaps g ON r.source IS NOT DISTINCT FROM g.source
    WHERE r.upto > r.rest AND r.size > 0 AND abs(r.size - g.gap) < g.gap GROUP BY r.source)
SELECT r.doc_id, r.size, r.source_size, r.target,
       (r.size * (r.epochs + CASE WHEN r.upto <= r.rest OR c.doc_id IS NOT NULL THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running r LEFT JOIN closing c ON r.doc_id = c.doc_id
""")
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to sources' weights of 5, 2, 1, repeating."""
    return mix_sources(documents(spark, sf_dir, "doc_id", "text", "source"), (5, 2, 1), total_share=1.5, most_epochs=2.0) \
        .select("doc_id", "size", "source_size", "target", "taken")


@query()
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in files, read back from them."""
    folder = token_folder(spark)
    index = write_token_files(documents(spark, sf_dir, "doc_id", "text"), public_path(), folder, end_id=2)
    return read_token_files(spark, index, folder)


@query()
def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, their edited texts and next documents."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    return compare_with_next(docs, lexicon(docs))


@query(r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM shingles),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT s.doc_id, any_value(len(s.s))::BIGINT AS n_shingles, min(r.other) AS component_id
FROM shingles s JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id
""")
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under a shingle likeness of 0.8."""
    return jaccard_components(documents(spark, sf_dir, "doc_id", "text"), words=5)


@query()
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by the byte model and by the word model."""
    return score_language(documents(spark, sf_dir, "doc_id", "text"))


@query("""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, s.vec_id, list_dot_product(q.e, s.e)::BIGINT AS score
    FROM v q JOIN v s ON q.vec_id <> s.vec_id AND len(q.e) = len(s.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
""")
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest by inner product of every 20th vector."""
    return exact_top_k(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda i: i % 20 == 0, k=20)


@query(r"""
WITH RECURSIVE src AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
hit AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
                              lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                                            lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS k FROM src),
kept AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
           CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hit WHERE k <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS p,
           CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '?' END AS initial FROM kept),
faults AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY p) || initial AS neighbours FROM placed),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
           count(*) FILTER (WHERE fault = 'truncated') AS truncated,
           count(*) FILTER (WHERE neighbours IS NOT NULL AND neighbours NOT IN ('su', 'ua', 'au')) AS illegal, max(p) AS last
    FROM faults GROUP BY conv_id),
inserts(s, t, c, e, o) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 5, 'I', chr(10) || 'user:'), (1, 2, 5, 'I', chr(10) || 'user:'), (3, 2, 5, 'I', chr(10) || 'user:'),
    (2, 3, 5, 'I', chr(10) || 'assistant:'), (0, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
    (1, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
follows(s, i, t, r) AS (VALUES (0, 's', 1, NULL), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')),
ways AS (
    SELECT conv_id, 0::BIGINT AS p, 0 AS state, {'c': 0, 'e': '', 'o': ''} AS way FROM counts
    UNION ALL
    SELECT conv_id, p, state, min(way) FROM (
        SELECT w.conv_id, f.p, i.t AS state, {'c': w.way.c + i.c + 2, 'e': w.way.e || i.e || 'D', 'o': w.way.o || i.o} AS way
        FROM ways w JOIN faults f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.p = w.p + 1 JOIN inserts i ON i.s = w.state
        UNION ALL
        SELECT w.conv_id, f.p, n.t, {'c': w.way.c + i.c + CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END,
               'e': w.way.e || i.e || 'K', 'o': w.way.o || i.o || chr(10) || f.role || ':' || f.text}
        FROM ways w JOIN faults f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.p = w.p + 1 JOIN inserts i ON i.s = w.state
        JOIN follows n ON n.s = i.t AND n.i = f.initial WHERE f.fault IN ('none', 'truncated')
        UNION ALL
        SELECT w.conv_id, f.p, n.t, {'c': w.way.c + i.c + 1 + CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END,
               'e': w.way.e || i.e || 'R', 'o': w.way.o || i.o || chr(10) || n.r || ':' || f.text}
        FROM ways w JOIN faults f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.p = w.p + 1 JOIN inserts i ON i.s = w.state
        JOIN follows n ON n.s = i.t AND n.r IS NOT NULL WHERE f.fault IN ('none', 'truncated'))
    GROUP BY conv_id, p, state),
ended AS (
    SELECT w.conv_id, min({'c': w.way.c + i.c, 'e': w.way.e || i.e, 'o': w.way.o || i.o}) AS way
    FROM ways w JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.p = c.last JOIN inserts i ON i.s = w.state
    WHERE i.t IN (0, 3) GROUP BY w.conv_id)
SELECT a.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(e.way.c, 0)::BIGINT AS cost,
       coalesce(e.way.e, '') AS audit, sha256(coalesce(substr(e.way.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counts c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON a.conv_id IS NOT DISTINCT FROM e.conv_id
""")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a rule and repaired by the cheapest edits."""
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, rows = repair_conversations(damaged(conv))
    empty = F.sha2(F.lit(""), 256)

    def side(df):
        return df.withColumnRenamed("conv_id", "_c")

    out = conv.select("conv_id").distinct() \
        .join(side(report), F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c") \
        .join(side(conversation_hashes(rows)), F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                   for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


@query(r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) t(k)) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 10),
cut AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
scored AS (
    SELECT c.lang, c.phrase, c.size, c.a, c.w, c.k, x.f AS l, y.f AS r, (c.a::HUGEINT * c.a * 1000000) // (x.f::HUGEINT * y.f) AS score
    FROM cut c JOIN grams x ON x.lang = c.lang AND x.k = c.k AND x.phrase = array_to_string(c.w[:c.k], ' ')
    JOIN grams y ON y.lang = c.lang AND y.k = c.size - c.k AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, phrase, max(a) AS longer FROM (
        SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidates WHERE size = 3)
    GROUP BY ALL),
kept AS (
    SELECT b.* FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.phrase = i.phrase
    WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, encode(k.phrase))::BIGINT AS rank,
       k.phrase, k.a, k.l, k.r, t.n, k.score::BIGINT AS score
FROM kept k JOIN totals t ON k.lang = t.lang QUALIFY rank <= 2000
""")
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 first phrases of two or three words."""
    found = top_phrases(collocations(documents(spark, sf_dir, "text", "lang"), max_words=3, min_count=10, inside_share=0.5), 2000)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


@query()
def op12_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts and hash of the base spans, and all spans."""
    found = private_spans(documents(spark, sf_dir, "doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))
