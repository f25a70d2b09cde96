"""All registered queries of the retrieval engine, with their SQL counterparts.

The queries see the test tables as a corpus: a chunk is a row of documents, its title the first
line, its author the language, its source the source; labels say which chunks are method cards
(quality 1) or conflicts (toxic 1).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions.folding import ASCII_LOWER, ASCII_UPPER, fold_pairs
from quillmark.functions.text import occurrences
from quillmark.operators import analytics, batch, compare, corpus, merkle, postings, search, validate
from quillmark.plans.query import parse
from quillmark.sources import html_chat, index, json_walk, pdf, registry, sinks

LONG, SHORT, MIXED = "the ment Étion", "en au", "é the en ET"
TERMS = ["the", "en", "Étion", "ment", "É", "*", "[", "of the"]
BATCH = {"long": LONG, "short": SHORT, "mixed": MIXED, "literal": "* ? ["}
COUNTED = ["the", "en", "Étion", "ment"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("chunk_id"), "quality", "toxic")
    return corpus.typed(plain_chunks(spark, sf_dir), labels.where("quality = 1"), labels.where("toxic = 1"))


def kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chunk_id, chunk_type of labelled chunks; searches join them to candidates alone."""
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("chunk_id"), "quality", "toxic")
    return corpus.kinds(labels.where("quality = 1"), labels.where("toxic = 1"))


def plain_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks without their types, for queries that don't rank."""
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), F.col("source").alias("source_id"), "text", F.substring_index("text", "\n", 1).alias("title"), F.col("lang").alias("author"))


def with_topics(c: DataFrame) -> DataFrame:
    low = F.translate("text", ASCII_UPPER, ASCII_LOWER)
    parts = [F.when(sum((occurrences(low, w) for w in words), F.lit(0)) > 0, t) for t, words in corpus.TOPICS.items()]
    return c.withColumn("topics_text", F.concat_ws(" ", *parts))


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("source").alias("source_id"), F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), "text", F.col("lang").alias("author"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("source").alias("source_id")).distinct()


_indexes: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Where an index of a table folder is stored; written once a session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _indexes:
        path = f"{sinks.scratch(spark)}/{name}-{uuid.uuid4().hex}"
        write(path)
        _indexes[key] = path
    return _indexes[key]


def stored_index(spark: SparkSession, sf_dir: str) -> index.Snapshot:
    """The stored index of documents as chunks."""
    return index.open_index(spark, _once(spark, sf_dir, "index", lambda path: index.write(path, chunks(spark, sf_dir))))


def library(spark: SparkSession, sf_dir: str) -> index.Snapshot:
    """The stored index of documents cut into parents and chunks."""

    def write(path: str) -> None:
        docs, parents, cut = _built(spark, sf_dir)
        index.write(path, cut, docs.drop("text"), parents)

    return index.open_index(spark, _once(spark, sf_dir, "library", write))


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- pieces of SQL ---------------------------------------------------------------------------

CHUNKS = """chunks AS (SELECT d.doc_id AS chunk_id, d.source AS source_id, coalesce(d.text, '') AS text,
 split_part(coalesce(d.text, ''), chr(10), 1) AS title, coalesce(d.lang, '') AS author,
 CASE WHEN l.q = 1 THEN 'curated_method' WHEN l.t = 1 THEN 'conflict' ELSE 'text' END AS chunk_type
 FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS q, max(toxic) AS t FROM labels GROUP BY doc_id) l USING (doc_id))"""


def _lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _fold(c: str, kind: str) -> str:
    src, dst = (ASCII_UPPER, ASCII_LOWER) if kind == "ascii" else fold_pairs()
    return f"translate({c}, {_lit(src)}, {_lit(dst)})"


FOLDED = f"folded AS (SELECT *, {', '.join(f'{_fold(c, k)} AS {c}_{k}' for c in search.FIELDS for k in ('ascii', 'unicode'))} FROM chunks)"


def _has(t, c: str) -> str:
    return f"contains({c}_{t.kind}, {_lit(t.folded)})"


def _any(t) -> str:
    return "(" + " OR ".join(_has(t, c) for c in search.FIELDS) + ")"


def _rank_sql(q: str, where: str = "TRUE") -> str:
    terms = parse(q)
    prose = " OR ".join(_has(t, "text") for t in terms)
    count = " + ".join(f"{_any(t)}::INT" for t in terms)
    points = " + ".join(f"{w} * least((length({c}_{t.kind}) - length(replace({c}_{t.kind}, {_lit(t.folded)}, ''))) // {len(t.folded)}, {cap})" for c, (w, cap) in search.FIELDS.items() for t in terms)
    bonus = "CASE chunk_type WHEN 'curated_method' THEN 5.0 WHEN 'conflict' THEN 2.0 ELSE 0.0 END"
    return f"""WITH {CHUNKS}, {FOLDED}, ranked AS (SELECT chunk_id, source_id, title, author, chunk_type, ({prose})::INT AS prose_hit, ({count})::INT AS term_count,
 CAST({points} + {bonus} AS DOUBLE) AS score FROM folded WHERE ({' OR '.join(_any(t) for t in terms)}) AND {where})"""


def _search_sql(q: str, limit: int, where: str = "TRUE") -> str:
    return f"{_rank_sql(q, where)} SELECT * FROM ranked ORDER BY prose_hit DESC, term_count DESC, score DESC, chunk_id LIMIT {limit}"


def _recall_sql(q: str) -> str:
    return f"WITH {CHUNKS}, {FOLDED} SELECT chunk_id FROM folded WHERE {' OR '.join(_any(t) for t in parse(q))}"


def _union(rows: list[str]) -> str:
    return " UNION ALL ".join(rows)


# ---- search ----------------------------------------------------------------------------------


@query(_search_sql(LONG, 40))
def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(plain_chunks(spark, sf_dir), LONG, 40, kinds=kinds(spark, sf_dir))


@query(_search_sql(LONG, 40, "source_id = 'src3'"))
def ranked_search_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(plain_chunks(spark, sf_dir), LONG, 40, source="src3", kinds=kinds(spark, sf_dir))


@query(_search_sql(LONG, 40, "author = 'fr'"))
def ranked_search_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(plain_chunks(spark, sf_dir), LONG, 40, author="fr", kinds=kinds(spark, sf_dir))


@query(_search_sql(MIXED, 40))
def ranked_search_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(plain_chunks(spark, sf_dir), MIXED, 40, kinds=kinds(spark, sf_dir))


@query(_search_sql(SHORT, 8))
def ranked_search_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(plain_chunks(spark, sf_dir), SHORT, kinds=kinds(spark, sf_dir))


@query(_search_sql("* ? [ %", 40))
def literal_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(plain_chunks(spark, sf_dir), "* ? [ %", 40, kinds=kinds(spark, sf_dir))


@query(f"SELECT 'blank' AS query, 0::BIGINT AS n UNION ALL SELECT 'sentinel', count(*) FROM ({_search_sql(LONG, 40)})")
def empty_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query without terms finds nothing, where another finds something."""
    c, k = plain_chunks(spark, sf_dir), kinds(spark, sf_dir)
    n = lambda name, q: search.search(c, q, 40, kinds=k).agg(F.count("*").alias("n")).select(F.lit(name).alias("query"), "n")
    return n("blank", "  ").unionByName(n("sentinel", LONG))


@query(_recall_sql(SHORT))
def recall_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.recall(plain_chunks(spark, sf_dir), SHORT).select("chunk_id")


@query(_recall_sql(LONG))
def recall_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.recall(plain_chunks(spark, sf_dir), LONG).select("chunk_id")


@query(_recall_sql("*"))
def recall_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.recall(plain_chunks(spark, sf_dir), "*").select("chunk_id")


SETS = ["Étion", "the", "É", "*"]


@query(f"WITH {CHUNKS}, {FOLDED} " + _union([f"SELECT {_lit(t)} AS term, count(*) AS recalled, count(*) AS by_instr, 0::BIGINT AS on_one_side FROM folded WHERE {_any(*parse(t))}" for t in SETS]))
def recall_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall and the substring union, member by member: how many each has, and how many only one has."""
    return analytics.recall_against_instr(plain_chunks(spark, sf_dir), SETS)


@query(f"WITH {CHUNKS} " + _union([f"SELECT {_lit(t)} AS term, count(*) AS literal, count(*) FILTER (WHERE contains(text, {_lit(t)})) AS in_text, count(*) FILTER (WHERE contains(title, {_lit(t)})) AS in_title, count(*) FILTER (WHERE author LIKE {_lit('%' + t + '%')}) AS in_author FROM chunks WHERE contains(text, {_lit(t)}) OR contains(title, {_lit(t)}) OR contains(author, {_lit(t)})" for t in ("The", "the", "ción", "en")]))
def literal_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case-sensitive literal union of the three fields, and its parts."""
    return analytics.literal_union(plain_chunks(spark, sf_dir), ["The", "the", "ción", "en"])


@query(f"WITH {CHUNKS} " + _union([f"SELECT {_lit(t)} AS term, count(*) AS by_like, count(*) AS by_instr, 0::BIGINT AS on_one_side FROM chunks WHERE text ILIKE {_lit('%' + t.replace('%', chr(92) + '%').replace('_', chr(92) + '_') + '%')} ESCAPE '{chr(92)}'" for t in ("the", "EN", "%", "a_b")]))
def like_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIKE with its wildcards escaped, and instr, over lower-cased ASCII text, member by member."""
    return analytics.like_against_instr(plain_chunks(spark, sf_dir), ["the", "EN", "%", "a_b"])


@query(f"SELECT row_number() OVER (ORDER BY prose_hit DESC, term_count DESC, score DESC, chunk_id)::INT AS place, chunk_id, TRUE AS same FROM ({_search_sql(LONG, 8)})")
def prefix_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each place among the first eight, and whether the first forty have the same chunk there."""
    return analytics.prefix_places(plain_chunks(spark, sf_dir), LONG, 8, 40, kinds(spark, sf_dir))


@query(_search_sql(compare.expand("the and"), 40))
def synonym_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(plain_chunks(spark, sf_dir), compare.expand("the and"), 40, kinds=kinds(spark, sf_dir))


@query(
    "SELECT * FROM ("
    + _union([f"SELECT {_lit(qid)} AS qid, * FROM ({_rank_sql(q)} SELECT (row_number() OVER (ORDER BY prose_hit DESC, term_count DESC, score DESC, chunk_id))::INT AS position, chunk_id, source_id, prose_hit, term_count, score FROM ranked)" for qid, q in BATCH.items()])
    + ") WHERE position <= 20"
)
def batch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.batch_search(plain_chunks(spark, sf_dir), BATCH, 20, kinds=kinds(spark, sf_dir))


@query(_recall_sql("Étion"))
def posting_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long term by the stored postings of its rarest grams, without text."""
    return postings.recall(stored_index(spark, sf_dir).index(), "Étion")


@query(f"{_rank_sql(LONG)} SELECT * EXCLUDE (title, author, chunk_type) FROM (SELECT *, (row_number() OVER (PARTITION BY source_id ORDER BY prose_hit DESC, term_count DESC, score DESC, chunk_id))::INT AS position FROM ranked) WHERE position <= 3")
def compare_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_sources(plain_chunks(spark, sf_dir), LONG, kinds=kinds(spark, sf_dir))


@query(f"{_rank_sql('**')}, top AS (SELECT source_id, count(*) AS n, min(chunk_id) AS c FROM ranked GROUP BY source_id) SELECT s.source_id, CASE WHEN n IS NULL THEN 0 ELSE least(n, 3) END AS n_hits, n IS NOT NULL AS found FROM (SELECT DISTINCT source AS source_id FROM documents) s LEFT JOIN top USING (source_id)")
def not_found_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.evidence(plain_chunks(spark, sf_dir), sources(spark, sf_dir), "**", kinds=kinds(spark, sf_dir)).select("source_id", "n_hits", "found")


@query(f"{_search_sql(LONG, 40)}".replace("SELECT * FROM ranked", "SELECT chunk_id, CASE chunk_type WHEN 'curated_method' THEN 'method card' ELSE 'chunk' END AS level FROM ranked"))
def provenance_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.with_level(search.search(plain_chunks(spark, sf_dir), LONG, 40, kinds=kinds(spark, sf_dir))).select("chunk_id", "level")


@query(f"{_rank_sql('tionthe')}, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY prose_hit DESC, term_count DESC, score DESC, chunk_id) AS r FROM ranked) WHERE r = 1) SELECT s.source_id, b.chunk_id, CASE WHEN b.chunk_id IS NULL THEN 'model' WHEN b.chunk_type = 'curated_method' THEN 'method card' ELSE 'chunk' END AS level FROM (SELECT DISTINCT source AS source_id FROM documents) s LEFT JOIN best b USING (source_id)")
def provenance_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.levels_by_source(plain_chunks(spark, sf_dir), sources(spark, sf_dir), "tionthe", kinds(spark, sf_dir))


@query(f"SELECT *, 0.0::DOUBLE AS rank FROM ({_search_sql(SHORT, 8)})")
def search_with_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.with_rank(search.search(plain_chunks(spark, sf_dir), SHORT, kinds=kinds(spark, sf_dir)))


# ---- counts ----------------------------------------------------------------------------------


@query(f"WITH {CHUNKS}, {FOLDED} " + _union([f"SELECT {_lit(t)} AS term, count(*) AS hits FROM folded WHERE {_any(*parse(t))}" for t in TERMS[:7]]))
def recall_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.recall_counts(plain_chunks(spark, sf_dir), TERMS[:7])


@query(f"WITH {CHUNKS}, {FOLDED} " + _union([f"SELECT {_lit(t)} AS term, source_id, count(*) AS hits FROM folded WHERE {_any(*parse(t))} GROUP BY source_id" for t in TERMS[:7]]))
def hits_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.hits_by_source(plain_chunks(spark, sf_dir), TERMS[:7])


def _topics_sql() -> str:
    low = _fold("text", "ascii")
    return ", ".join("CASE WHEN " + " OR ".join(f"contains({low}, {_lit(w)})" for w in words) + f" THEN {_lit(t)} END" for t, words in corpus.TOPICS.items())


def _decomposition_sql(terms: list[str]) -> str:
    rows = []
    for t in terms:
        (p,) = parse(t)
        prose, union, topics = _has(p, "text"), _any(p), f"contains(topics_text, {_lit(p.folded)})"
        count = lambda c: f"count(*) FILTER (WHERE {c})"
        rows.append(f"SELECT {_lit(t)} AS term, {count(prose)} AS prose, {count(f'{union} AND NOT {prose}')} AS title_author_only, {count(union)} AS union_hits, {count(f'{topics} AND NOT {union}')} AS topics_only, {count(f'{union} OR {topics}')} AS all_fields FROM labelled")
    return f"WITH {CHUNKS}, {FOLDED}, labelled AS (SELECT *, concat_ws(' ', {_topics_sql()}) AS topics_text FROM folded) " + _union(rows)


@query(_decomposition_sql(COUNTED))
def field_decomposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.field_decomposition(with_topics(plain_chunks(spark, sf_dir)), COUNTED)


@query(f"SELECT term, CASE WHEN all_fields > 0 THEN 1 - prose / all_fields END AS noise FROM ({_decomposition_sql(COUNTED)})")
def noise_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.noise_ratio(with_topics(plain_chunks(spark, sf_dir)), COUNTED)


SMOKE = """top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY length(text) DESC, chunk_id) AS r FROM {chunks}) WHERE r <= 40),
 g AS (SELECT DISTINCT source_id, chunk_id, substr(text, i::BIGINT, 3) AS gram FROM top, unnest(generate_series(1, length(text) - 2)) AS u(i)),
 n AS (SELECT source_id, gram, count(*) AS n_chunks FROM g WHERE NOT regexp_matches(gram, '[ \\t\\n\\x0B\\f\\r]') GROUP BY ALL)"""


@query(f"WITH {CHUNKS}, {SMOKE.format(chunks='chunks')} SELECT source_id, gram, n_chunks FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY n_chunks DESC, gram) AS r FROM n WHERE n_chunks >= 3) WHERE r = 1")
def smoke_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.smoke_terms(plain_chunks(spark, sf_dir))


DOMINANT = "dominant AS (SELECT source_id, author, n_chunks FROM (SELECT source AS source_id, lang AS author, count(*) AS n_chunks, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) AS r FROM documents WHERE lang IS NOT NULL GROUP BY source, lang) WHERE r = 1)"


@query(f"WITH {DOMINANT} SELECT * FROM dominant")
def dominant_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.dominant_author(plain_chunks(spark, sf_dir))


@query(f"WITH {CHUNKS}, {DOMINANT}, own AS (SELECT c.* FROM chunks c JOIN dominant USING (source_id, author)), {SMOKE.format(chunks='own')} SELECT source_id, author, gram, n_chunks FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY n_chunks DESC, gram) AS r FROM n WHERE n_chunks >= 3) b JOIN (SELECT source_id, author FROM dominant) USING (source_id) WHERE r = 1")
def dominant_author_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.dominant_author_smoke(plain_chunks(spark, sf_dir))


@query("SELECT source AS source_id, count(*) AS n_chunks FROM documents GROUP BY source")
def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.chunk_counts(_table(spark, sf_dir, "documents").select(F.col("source").alias("source_id")))


@query("SELECT source AS source_id, count(*) AS documents, count(l.doc_id) AS labelled, count(*) > 0 AND count(l.doc_id) > 0 AS nonempty FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source")
def source_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_id"))
    return analytics.source_nonempty(sources(spark, sf_dir), {"documents": docs, "labelled": docs.join(_table(spark, sf_dir, "labels"), "doc_id").select("source_id")})


@query("SELECT count(DISTINCT source) AS n_sources, count(DISTINCT lang) AS n_authors FROM documents")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.distinct_counts(plain_chunks(spark, sf_dir))


@query(f"SELECT 'the ment Étion' AS query, 8 AS k, avg(prose_hit) AS precision FROM ({_search_sql(LONG, 8)})")
def precision_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.precision_at_k(plain_chunks(spark, sf_dir), LONG, kinds=kinds(spark, sf_dir))


@query(_union([f"SELECT '{c}' AS column_name, coalesce(sum(length({c}) - length(replace({c}, chr(0), ''))), 0)::BIGINT AS nuls, count(*) FILTER (WHERE contains({c}, chr(0))) AS rows_with_nul FROM documents" for c in ("text", "lang", "source")]))
def nul_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.nul_audit(_table(spark, sf_dir, "documents"), ["text", "lang", "source"])


# ---- corpus ----------------------------------------------------------------------------------

BUILT = """raw AS (SELECT source AS source_id, source || '/' || doc_id AS path, coalesce(text, '') AS text, coalesce(nullif(trim(lang), ''), 'not identified') AS author FROM documents),
 docs AS (SELECT 'doc-' || substr(sha256(path), 1, 12) AS doc_id, source_id, split_part(text, chr(10), 1) AS title, author, path, sha256(text) AS sha256, text FROM raw),
 parents AS (SELECT printf('%s-p%03d', doc_id, i - 1) AS parent_id, doc_id, source_id, (i - 1)::INT AS ord, lines[i] AS text FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS lines FROM docs) t, unnest(generate_series(1, len(lines))) AS u(i)),
 cut AS (SELECT printf('%s-c%02d', parent_id, i) AS chunk_id, parent_id, doc_id, source_id, i::INT AS ord, substr(text, (i * 800 + 1)::BIGINT, 800) AS text FROM parents, unnest(generate_series(0, (length(text) - 1) // 800)) AS u(i))"""


def _built(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = corpus.documents_of(raw_files(spark, sf_dir))
    parents = corpus.parents_of(docs)
    return docs, parents, corpus.chunks_of(parents, docs)


@query(f"WITH {BUILT} SELECT doc_id, source_id, title, author, path, sha256 FROM docs")
def corpus_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir)[0].drop("text")


@query(f"WITH {BUILT} SELECT d.doc_id, d.source_id, d.title, d.author, d.path, d.sha256, coalesce(p.n, 0) AS n_parents, coalesce(c.n, 0) AS n_chunks FROM docs d LEFT JOIN (SELECT doc_id, count(*) AS n FROM parents GROUP BY doc_id) p USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM cut GROUP BY doc_id) c USING (doc_id) WHERE d.source_id = 'src3'")
def registration_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What registering one source would add, document by document."""
    return registry.preview_documents(raw_files(spark, sf_dir).where("source_id = 'src3'"))


@query("SELECT event_id, (CASE WHEN event_id % 2 = 0 THEN 2 ELSE 0 END)::BIGINT AS nuls FROM events WHERE json_valid(props)")
def json_nul_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULs in parsed JSON at any depth: two are put into every second row, as escapes inside nested values; the rest have none."""
    props = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"a":[{"k\\u0000":"x\\u0000"}],"b":"\\\\u0000","c":'), F.col("props"), F.lit("}"))).otherwise(F.col("props"))
    return _table(spark, sf_dir, "events").select("event_id", html_chat.parsed_nul_count(props).alias("nuls"))


@query("""WITH e AS (SELECT event_id, '{"id":' || event_id || ',"at":[[{"type":' || to_json(event_type) || '}],[]],"props":' || props || '}' AS j FROM events WHERE json_valid(props))
SELECT event_id, t.fullkey AS path, CASE t.type WHEN 'OBJECT' THEN '{}' WHEN 'ARRAY' THEN '[]' ELSE t.atom::VARCHAR END AS value FROM e, json_tree(e.j) t
WHERE t.type NOT IN ('OBJECT', 'ARRAY') OR t.value::VARCHAR IN ('{}', '[]')""")
def json_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each leaf of nested JSON with its path."""
    whole = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"at":[[{"type":"'), "event_type", F.lit('"}],[]],"props":'), "props", F.lit("}"))
    return json_walk.leaves(_table(spark, sf_dir, "events").select("event_id", whole.alias("j")), "j", ["event_id"])


@query("""SELECT event_id, path, kind, position::BIGINT AS position FROM events, (VALUES ('$.a[0]."k\\u0000"', 'key', 2), ('$.a[0]."k\\u0000"', 'value', 1), ('$.a[0]."k\\u0000"', 'value', 3)) n(path, kind, position)
WHERE json_valid(props) AND event_id % 2 = 0""".replace("\\\\", "\\"))
def json_nul_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per NUL of parsed JSON: three are put into every second row, in a nested key and its value; the rest have none."""
    props = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"a":[{"k\\u0000":"\\u0000x\\u0000"}],"b":"\\\\u0000","c":'), F.col("props"), F.lit("}"))).otherwise(F.col("props"))
    return json_walk.nuls(_table(spark, sf_dir, "events").select("event_id", props.alias("j")), "j", ["event_id"])


@query("SELECT doc_id, 1::INT AS page, rtrim(text, chr(10)) AS text FROM documents WHERE text IS NOT NULL")
def pdf_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text layers of PDF files made of each document, read back."""
    made = _table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").cast("string").alias("sha256"), pdf.as_pdf(F.split("text", "\n")).alias("content"))
    return pdf.pages_of(made).select(F.col("sha256").cast("long").alias("doc_id"), "page", F.rtrim("text", F.lit("\n")).alias("text"))


@query(f"WITH {BUILT} SELECT * FROM parents")
def paragraph_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir)[1]


@query(f"WITH {BUILT} SELECT chunk_id, parent_id, doc_id, source_id, ord, text FROM cut")
def paragraph_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir)[2].select("chunk_id", "parent_id", "doc_id", "source_id", "ord", "text")


@query(f"WITH {BUILT} SELECT c.chunk_id, c.parent_id, p.ord AS parent_ord, d.path, d.sha256 FROM cut c JOIN parents p USING (parent_id) JOIN docs d ON d.doc_id = c.doc_id")
def traceability(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, parents, cut = _built(spark, sf_dir)
    return corpus.trace(cut, parents, docs).select("chunk_id", "parent_id", "parent_ord", "path", "sha256")


@query("SELECT * FROM (" + _union([f"SELECT doc_id AS chunk_id, '{t}' AS topic FROM documents WHERE " + " OR ".join(f"contains({_fold('text', 'ascii')}, {_lit(w)})" for w in words) for t, words in corpus.TOPICS.items()]) + ")")
def topic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), F.explode(corpus.infer_topics(F.col("text"))).alias("topic"))


@query(_recall_sql(MIXED))
def indexed_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall of short and long terms by the stored postings."""
    return postings.recall(stored_index(spark, sf_dir).index(), MIXED)


@query(_recall_sql("É * tionthe"))
def indexed_recall_rare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall of rare short terms, whose lists name few blocks, and of a long one."""
    return postings.recall(stored_index(spark, sf_dir).index(), "É * tionthe")


@query(_search_sql(LONG, 40))
def indexed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.find(stored_index(spark, sf_dir), LONG, 40, stepwise=False).select(*search.RESULT)


@query(_search_sql(MIXED, 8))
def top_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first results by blocks of falling bound."""
    return index.find(stored_index(spark, sf_dir), MIXED, 8).select(*search.RESULT)


@query(_search_sql("tionthe *", 8, "source_id = 'src3'"))
def top_search_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.find(stored_index(spark, sf_dir), "tionthe *", 8, source="src3").select(*search.RESULT)


@query(ORACLES["batch_search"])
def indexed_batch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.batch(stored_index(spark, sf_dir).index(), BATCH, 20)


@query(ORACLES["compare_sources"])
def indexed_compare_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.batch(stored_index(spark, sf_dir).index(), {"q": LONG}, 3, by_source=True).drop("qid")


@query(f"WITH {CHUNKS}, {FOLDED} " + _union([f"SELECT {_lit(t)} AS term, source_id, count(*) AS hits, count(*) FILTER (WHERE {_has(parse(t)[0], 'text')}) AS prose, count(*) FILTER (WHERE NOT {_has(parse(t)[0], 'text')}) AS title_author_only FROM folded WHERE {_any(*parse(t))} GROUP BY source_id" for t in TERMS[:7]]))
def indexed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of each term by source and field, counted from postings alone."""
    held = postings.hits(stored_index(spark, sf_dir).index(), TERMS[:7])
    prose = F.col("text") > 0
    return held.groupBy("term", "source_id").agg(F.count("*").alias("hits"), F.count_if(prose).alias("prose"), F.count_if(~prose).alias("title_author_only"))


@query(f"WITH {BUILT} SELECT 'chunks' AS table_name, count(*) AS n_rows FROM cut UNION ALL SELECT 'documents', count(*) FROM docs UNION ALL SELECT 'parents', count(*) FROM parents")
def index_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored library's tables with the rows they hold."""
    snapshot = library(spark, sf_dir)
    made = [snapshot.table(name).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name in ("chunks", "documents", "parents")]
    return made[0].unionByName(made[1]).unionByName(made[2])


LIBRARY = BUILT + """, chunks AS (SELECT c.chunk_id, c.parent_id, c.doc_id, c.source_id, c.text, d.title, d.author, 'text' AS chunk_type, p.ord AS parent_ord, d.path, d.sha256
 FROM cut c JOIN docs d USING (doc_id) JOIN parents p ON p.parent_id = c.parent_id)"""


@query(_search_sql(LONG, 40).replace(CHUNKS, LIBRARY).replace("SELECT * FROM ranked ORDER", "SELECT ranked.chunk_id, ranked.source_id, prose_hit, term_count, score, parent_ord, path, sha256 FROM ranked JOIN chunks USING (chunk_id) ORDER").replace("score DESC, chunk_id", "score DESC, ranked.chunk_id"))
def library_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the command line asks: results of the stored library, each with its locator."""
    snapshot = library(spark, sf_dir)
    found = index.find(snapshot, LONG, 40, columns=("parent_id",))
    return corpus.trace(F.broadcast(found), snapshot.table("parents"), snapshot.table("documents")).select("chunk_id", "source_id", "prose_hit", "term_count", "score", "parent_ord", "path", "sha256")


def _earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw files in an earlier state: some missing, some with another text, one more."""
    raw, number = raw_files(spark, sf_dir), F.substring_index("path", "/", -1).try_cast("long")
    old = raw.where(number % 5 != 0).withColumn("text", F.when(number % 7 == 0, F.concat(F.lit("earlier the "), "text")).otherwise(F.col("text")))
    return old.unionByName(spark.createDataFrame([("src0", "src0/gone", "gone the", "en")], "source_id string, path string, text string, author string"))


def _updated(spark: SparkSession, sf_dir: str) -> index.Snapshot:
    def write(path: str) -> None:
        index.update(path, _earlier(spark, sf_dir))
        index.update(path, raw_files(spark, sf_dir))

    return index.open_index(spark, _once(spark, sf_dir, "updated", write))


@query(f"WITH {BUILT} SELECT chunk_id, parent_id, doc_id, source_id, ord, text FROM cut")
def incremental_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks of an index that was brought from an earlier state to this one by what changed."""
    return _updated(spark, sf_dir).table("chunks").select("chunk_id", "parent_id", "doc_id", "source_id", "ord", "text")


@query(ORACLES["library_search"])
def incremental_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library search over that index: two segments and a removal."""
    snapshot = _updated(spark, sf_dir)
    found = index.find(snapshot, LONG, 40, columns=("parent_id",))
    return corpus.trace(F.broadcast(found), snapshot.table("parents"), snapshot.table("documents")).select("chunk_id", "source_id", "prose_hit", "term_count", "score", "parent_ord", "path", "sha256")


# ---- registry and provenance -----------------------------------------------------------------


@query("SELECT 'id_sets' AS \"check\", source_id, 'missing in ' || concat_ws(',', CASE WHEN NOT r THEN 'registry' END, CASE WHEN NOT d THEN 'directory' END, CASE WHEN NOT i THEN 'index' END) AS detail FROM (SELECT source_id, bool_or(k = 1) AS r, bool_or(k = 2) AS d, bool_or(k = 3) AS i FROM (SELECT source AS source_id, 1 AS k FROM documents UNION ALL SELECT role, 2 FROM conversations UNION ALL SELECT lang, 3 FROM documents) GROUP BY source_id) WHERE NOT (r AND d AND i)")
def registry_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return validate.id_sets(docs.select(F.col("source").alias("source_id")), _table(spark, sf_dir, "conversations").select(F.col("role").alias("source_id")), docs.select(F.col("lang").alias("source_id")))


def _manifest(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("path"), F.sha2("text", 256).alias("sha256"))


@query("SELECT path, CASE WHEN o IS NULL THEN 'added' WHEN n IS NULL THEN 'removed' WHEN o = n THEN 'unchanged' ELSE 'changed' END AS state FROM (SELECT doc_id::VARCHAR AS path, sha256(text) AS o FROM documents) FULL JOIN (SELECT item_id::VARCHAR AS path, sha256(text) AS n FROM benchmark) USING (path)")
def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.manifest_diff(_manifest(_table(spark, sf_dir, "documents"), "doc_id"), _manifest(_table(spark, sf_dir, "benchmark"), "item_id"))


def _files(raw: DataFrame) -> DataFrame:
    return raw.select("source_id", "path", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size"))


def _tree_sql(lines: str) -> str:
    """A manifest's tree of rows (source_id, path, line); level6 to level0."""
    levels = [f"level6 AS (SELECT source_id, substr(sha256(path), 1, 6) AS p, sha256(string_agg(line, chr(10) ORDER BY line)) AS d, count(*) AS n FROM ({lines}) GROUP BY ALL)"]
    levels += [f"level{k} AS (SELECT source_id, substr(p, 1, {k}) AS p, sha256(string_agg(p || ':' || d, chr(10) ORDER BY p)) AS d, sum(n)::BIGINT AS n FROM level{k + 2} GROUP BY source_id, substr(p, 1, {k}))" for k in (4, 2, 0)]
    return ", ".join(levels)


DOCUMENT_LINES = "SELECT source AS source_id, source || '/' || doc_id AS path, source || '/' || doc_id || chr(9) || sha256(text) || chr(9) || octet_length(encode(text)) AS line FROM documents"


@query(f"WITH {_tree_sql(DOCUMENT_LINES)} SELECT source_id, d AS manifest_digest, n AS file_count FROM level0")
def manifest_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digests(_files(raw_files(spark, sf_dir)))


@query(f"WITH {_tree_sql(DOCUMENT_LINES)} SELECT source_id, 4 AS level, p AS prefix, d AS digest, n AS file_count FROM level4 UNION ALL SELECT source_id, 2, p, d, n FROM level2")
def manifest_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inner nodes of the sources' manifest trees."""
    return merkle.tree(_files(raw_files(spark, sf_dir))).where("level in (4, 2)").select("source_id", "level", "prefix", "digest", "file_count")


@query("SELECT source AS source_id, source || '/' || doc_id AS path, CASE WHEN doc_id % 5 = 0 THEN 'added' ELSE 'changed' END AS state FROM documents WHERE doc_id % 5 = 0 OR doc_id % 7 = 0 UNION ALL SELECT 'src0', 'src0/gone', 'removed'")
def manifest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed since an earlier state, found by descending two stored manifest trees."""
    old, new = _files(_earlier(spark, sf_dir)), _files(raw_files(spark, sf_dir))

    def write(path: str) -> None:
        merkle.tree(old).write.parquet(f"{path}/old")
        merkle.tree(new).write.parquet(f"{path}/new")

    path = _once(spark, sf_dir, "trees", write)
    return merkle.changes(old, new, spark.read.parquet(f"{path}/old"), spark.read.parquet(f"{path}/new"))


@query(f"WITH {CHUNKS}, {FOLDED}, found AS (SELECT DISTINCT source_id FROM folded WHERE author = 'fr' AND {_any(*parse('la'))}) SELECT DISTINCT d.source AS source_id, f.source_id IS NOT NULL AS has_results FROM documents d LEFT JOIN found f ON f.source_id = d.source WHERE d.lang = 'fr'")
def author_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources of an author, and which of them a search of that author alone gives; no other source may appear."""
    return analytics.author_sources(plain_chunks(spark, sf_dir), "la", "fr")


@query(
    f"""WITH {BUILT} SELECT 'fold_version' AS "check", source_id, count(*)::VARCHAR AS detail FROM cut WHERE source_id = 'src3' GROUP BY source_id
 UNION ALL SELECT 'id_sets', 'nowhere', 'missing in directory,index' UNION ALL SELECT 'id_sets', 'src4', 'missing in registry'
 UNION ALL SELECT 'integrity', source_id, chunk_id || ' x2' FROM cut WHERE source_id = 'src5' AND ord = 1
 UNION ALL SELECT 'nul_free', source_id, 'text=' || count(*) FROM cut WHERE source_id = 'src6' GROUP BY source_id
 UNION ALL SELECT 'nul_free', source_id, 'title=' || count(*) FROM cut WHERE source_id = 'src7' GROUP BY source_id"""
)
def corpus_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of a corpus into which one fault of each kind is put; what has none gives no row."""
    docs, _, cut = _built(spark, sf_dir)
    own = F.col("source_id")
    faulty = cut.unionByName(cut.where((own == "src5") & (F.col("ord") == 1)))
    faulty = faulty.withColumn("text", F.when(own == "src6", F.concat("text", F.lit("\0"))).otherwise(F.col("text"))).withColumn("title", F.when(own == "src7", F.concat("title", F.lit("\0"))).otherwise(F.col("title")))
    index = corpus.index_of(cut).withColumn("fold_version", F.when(own == "src3", "fold-0").otherwise(F.col("fold_version")))
    ids = sources(spark, sf_dir)
    registry = ids.where(own != "src4").unionByName(spark.createDataFrame([("nowhere",)], "source_id string"))
    return validate.all_violations(validate.id_sets(registry, docs, cut), validate.integrity(faulty), validate.fold_version(index), validate.nul_free(faulty, ["text", "title", "author"]))


_RAN = [c for c in validate.CHECKS if c not in ("smoke_length", "source_reachable", "author_reachable", "recall_coverage")]


@query(
    f"""WITH {BUILT}, v AS (SELECT "check" FROM ({ORACLES['corpus_violations']}) UNION ALL SELECT w FROM (VALUES ('run_status'), ('source_credentials'), ('row_counts'), ('nonempty')) AS t(w)
  UNION ALL SELECT 'raw_unchanged' FROM documents WHERE source = 'src2' AND doc_id % 3 = 0
  UNION ALL SELECT 'manifest_digest' WHERE EXISTS (FROM documents WHERE source = 'src2' AND doc_id % 3 = 0)
  UNION ALL SELECT 'outputs' WHERE EXISTS (FROM cut WHERE source_id = 'src8' AND ord = 1))
 SELECT c AS "check", CASE WHEN c IN ({', '.join(_lit(c) for c in _RAN)}) THEN (SELECT count(*) FROM v WHERE v."check" = c) END AS violations,
 CASE WHEN c NOT IN ({', '.join(_lit(c) for c in _RAN)}) THEN 'not run' WHEN EXISTS (SELECT 1 FROM v WHERE v."check" = c) THEN 'failed' ELSE 'passed' END AS status
 FROM (VALUES {', '.join(f"('{c}')" for c in validate.CHECKS)}) AS t(c)"""
)
def validator_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a corpus and its credentials, digests made anew from the tables, with faults of several kinds put in; those of a stored index are not run here."""
    docs, parents, cut = _built(spark, sf_dir)
    own, ids = F.col("source_id"), sources(spark, sf_dir)
    then = _files(raw_files(spark, sf_dir))
    now = _files(raw_files(spark, sf_dir).withColumn("text", F.when((own == "src2") & (F.substring_index("path", "/", -1).try_cast("long") % 3 == 0), F.concat("text", F.lit("!"))).otherwise(F.col("text"))))
    product = lambda c: merkle.digests(c.select("source_id", F.col("chunk_id").alias("path"), F.sha2("text", 256).alias("sha256"), F.length("text").cast("long").alias("size"))).select("source_id", F.col("manifest_digest").alias("outputs_sha256"))
    altered = cut.withColumn("text", F.when((own == "src8") & (F.col("ord") == 1), F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    credential = lambda status, attempt: ids.join(merkle.digests(then), "source_id").join(product(cut), "source_id", "left").select("source_id", status.alias("status"), attempt.alias("attempt_id"), "manifest_digest", "outputs_sha256")
    status = F.when(own == "src1", "in_progress").otherwise("success")
    said, has = credential(status, F.lit("run")), credential(status, F.when(own == "src9", "old run").otherwise("run"))
    faults = [
        corpus_violations(spark, sf_dir),
        validate.nonempty(ids.unionByName(spark.createDataFrame([("empty",)], "source_id string")), {"documents": docs}),
        validate.row_counts({"documents": -1}, {"documents": docs}),
        validate.raw_unchanged(then, now), validate.run_status(said), validate.manifest_digests(said, now), validate.outputs(said, product(altered)), validate.source_credentials(said, has),
    ]
    return validate.report(validate.all_violations(*faults), _RAN)
