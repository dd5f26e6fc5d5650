"""Queries by name, each over its whole tables, with the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.rules import ABOUT_THE_DOCUMENT, CONTEXT_DEPENDENT, abstention_note, abstention_outcome, normal_type, reject_reason
from sievework.functions.text import STOP_WORDS, or_true, source_name
from sievework.operators import agreement, budget, checkpoints, dedup, explorer, generation, grounding, ingest, judging, statistics, sweeps
from sievework.operators.deliveries import latest
from sievework.operators.ordinals import with_ordinal
from sievework.schemas import EXPORT_FIELDS
from sievework.session import cut, table
from sievework.sources import files
from sievework.streaming.ingest import log_counts as hourly_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# ---- views, in Spark and in SQL

_WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


def _strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def _name(x: str = "source") -> str:
    return rf"nullif(lower(regexp_replace(regexp_replace({x}, '^.*[/\\]', '', 's'), '^[ \t]+|[ \t]+$', '', 'g')), '')"


_PAIRS = "pairs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY written_at DESC) AS nth FROM synthetic_dataset) WHERE nth = 1)"
_WINDOWS = f"""windows AS (
  SELECT * FROM (SELECT doc_id, source, start_index, substring(text, start_index + 1, 600) AS c FROM (SELECT doc_id, source, text, unnest(range(0, length(text), 520)) AS start_index FROM documents))
  WHERE length({_strip("c")}) >= 100
)"""
_REASON = f"""CASE
    WHEN regexp_matches(c, '{ingest.DOT_LEADER}') THEN 'table_of_contents'
    WHEN regexp_matches(c, '(?i){_q(ingest.FRONT_MATTER)}') THEN 'front_matter'
    WHEN regexp_matches(c, '(?i){ingest.LINK}') AND regexp_matches(c, '(?i){ingest.JOURNAL}') THEN 'reference_list'
    WHEN len(regexp_extract_all(c, '{_q(ingest.NAME_AFFILIATION)}')) >= 3 THEN 'contributor_list'
    WHEN len(regexp_extract_all(c, '\\p{{Nd}}')) * 4 > length(c) THEN 'numeric_table' END"""
_G, _S, _C = (f"scores.{k}" for k in ("groundedness", "specificity", "completeness"))
_TOTAL = f"CASE WHEN coalesce({_G}, {_S}, {_C}) IS NOT NULL THEN coalesce({_G}, 0) + coalesce({_S}, 0) + coalesce({_C}, 0) END"
_FLOORS = f"coalesce({_G}, 0) >= 2 AND coalesce({_S}, 0) >= 1 AND coalesce({_C}, 0) >= 1"
_KEEP = f"coalesce(({_TOTAL}) >= 4 AND {_FLOORS}, false)"
_OUTCOME = f"CASE WHEN ({_TOTAL}) IS NULL THEN 'not_assessed' WHEN {_KEEP} THEN 'kept' ELSE 'rejected' END"


def _pairs(s: SparkSession, d: str, *columns: str) -> DataFrame:
    """Each pair once, as last delivered, with the columns asked for (all if none is), so that no others are read."""
    t = table(s, d, "synthetic_dataset").filter("pair_id is not null")
    rest = list(columns) or [c for c in t.columns if c not in ("pair_id", "written_at")]
    if "answer" in rest:  # long texts are only shuffled where a pair comes again
        return latest(t.select("pair_id", "written_at", *rest), "pair_id", F.col("written_at")).select("pair_id", *rest)
    return t.groupBy("pair_id").agg(F.max(F.struct("written_at", *rest)).alias("r")).select("pair_id", *[f"r.{c}" for c in rest])


def _windows(s: SparkSession, d: str) -> DataFrame:
    return ingest.keep_chunks(ingest.window_chunks(table(s, d, "documents"), ["doc_id", "source"], "text"))


# ---- pages and chunks


@query(f"""SELECT {_name()} AS source_file, count(*) AS pages, sum(length(coalesce(text, ''))) AS chars, count_if(length({_strip("text")}) >= 200) AS kept_pages,
  sum(length(coalesce(text, ''))) // count(*) AS chars_per_page, sum(length(coalesce(text, ''))) // count(*) < 100 AS scanned FROM documents GROUP BY 1""")
def page_filter_profile(s: SparkSession, d: str) -> DataFrame:
    return ingest.scan_quality(table(s, d, "documents").withColumn("source_file", source_name(F.col("source"))), "source_file", "text")


@query(f"WITH {_WINDOWS} SELECT doc_id, start_index, length(c) AS chars, md5(c) AS digest FROM windows")
def chunk_windows(s: SparkSession, d: str) -> DataFrame:
    return _windows(s, d).select("doc_id", F.col("start_index").cast("bigint").alias("start_index"), F.length("page_content").cast("bigint").alias("chars"), F.md5(F.col("page_content").cast("binary")).alias("digest"))


@query()
def chunk_recursive(s: SparkSession, d: str) -> DataFrame:
    return ingest.keep_chunks(ingest.recursive_chunks(table(s, d, "documents"), ["doc_id"], "text"))


_PARAS = f"paras AS (SELECT doc_id, string_split({_strip('replace(text, chr(13) || chr(10), chr(10))')}, chr(10) || chr(10)) AS p FROM documents)"
_TURN = "open <> '' AND length(open) + length(p[k + 1]) > 3000"


@query(f"""WITH RECURSIVE {_PARAS},
packed AS (
  SELECT doc_id, p, 1 AS k, p[1] AS open, NULL::VARCHAR AS closed FROM paras
  UNION ALL
  SELECT doc_id, p, k + 1, CASE WHEN {_TURN} OR open = '' THEN p[k + 1] ELSE open || chr(10) || chr(10) || p[k + 1] END, CASE WHEN {_TURN} THEN open END FROM packed WHERE k < len(p)
),
pages AS (SELECT doc_id, k, {_strip("closed")} AS c FROM packed WHERE closed IS NOT NULL UNION ALL SELECT doc_id, k + 1, {_strip("open")} FROM packed WHERE k = len(p))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1)::INT AS page, c AS page_content FROM pages WHERE c <> ''""")
def pseudo_pages(s: SparkSession, d: str) -> DataFrame:
    return ingest.pseudo_pages(table(s, d, "documents").select("doc_id", "text"), "text")


@query(f"WITH {_WINDOWS} SELECT {_REASON} AS reason, count(*) AS chunks FROM windows GROUP BY 1")
def boilerplate_reasons(s: SparkSession, d: str) -> DataFrame:
    return ingest.boilerplate_report(_windows(s, d))


@query(f"WITH {_WINDOWS} SELECT {_name()} AS source_file, count(*) AS chunks FROM windows WHERE ({_REASON}) IS NULL GROUP BY 1")
def chunks_per_source(s: SparkSession, d: str) -> DataFrame:
    return ingest.source_chunk_counts(ingest.drop_boilerplate(_windows(s, d)).withColumn("source_file", source_name(F.col("source"))), "source_file")


@query(f"""WITH numbered AS (SELECT doc_id, row_number() OVER (ORDER BY {_name()} NULLS FIRST, page NULLS FIRST, doc_id) - 1 AS ord, count(*) OVER () AS n FROM documents)
SELECT ord, doc_id FROM numbered WHERE n <= 100 OR ord IN (SELECT floor(i * ((SELECT count(*) FROM documents)::DOUBLE / 100.0::DOUBLE))::BIGINT FROM range(100) r(i))""")
def stride_sample(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select(source_name(F.col("source")).alias("s"), "page", "doc_id")
    return ingest.evenly_spaced(docs, [F.col("s"), F.col("page"), F.col("doc_id")], 100).select("ord", "doc_id")


@query(f"""WITH counts AS (SELECT {_name()} AS source_file, count(*) AS pages FROM documents GROUP BY 1),
shares AS (SELECT *, greatest(3, round_even({ingest.page_budget(75)}.0::DOUBLE * pages / sum(pages) OVER (), 0)::INT) AS share, sum(pages) OVER () AS total FROM counts),
chosen AS (SELECT source_file, pages, CASE WHEN total <= {ingest.page_budget(75)} OR share >= pages THEN pages ELSE share END AS n FROM shares)
SELECT DISTINCT source_file, floor(i * (pages::DOUBLE / n::DOUBLE))::INT AS page FROM (SELECT source_file, pages, n, unnest(range(n)) AS i FROM chosen)""")
def page_budget_plan(s: SparkSession, d: str) -> DataFrame:
    counts = table(s, d, "documents").groupBy(source_name(F.col("source")).alias("source_file")).agg(F.count("*").alias("pages"))
    return ingest.sampled_pages(cut(counts), ingest.page_budget(75))


@query(f"SELECT {_name()} AS source_file, floor(sum(length(coalesce(text, ''))) / 520 * 0.8::DOUBLE)::BIGINT AS chunks FROM documents GROUP BY 1")
def chunk_estimates(s: SparkSession, d: str) -> DataFrame:
    chars = F.sum(F.length(F.coalesce("text", F.lit(""))))
    return table(s, d, "documents").groupBy(source_name(F.col("source")).alias("source_file")).agg(ingest.chunk_estimate(chars).alias("chunks"))


@query(f"""SELECT name, upper(regexp_extract(name, '\\.([^.]+)$', 1)) AS type, round(bytes / 1e6, 2) AS size_mb, CASE WHEN regexp_extract(name, '\\.([^.]+)$', 1) = 'pdf' THEN 'real page numbers' ELSE 'split into pages of about 3000 characters' END AS note
  FROM (SELECT {_name()} AS name, max((size_mb * 1e6)::BIGINT) AS bytes FROM source_files GROUP BY 1) WHERE name IS NOT NULL""")
def source_listing(s: SparkSession, d: str) -> DataFrame:
    named = table(s, d, "source_files").select(source_name(F.col("source")).alias("source_file"), F.round(F.col("size_mb") * 1e6).cast("bigint").alias("length")).filter("source_file is not null")
    return files.listing(named.groupBy("source_file").agg(F.max("length").alias("length")).withColumn("suffix", F.regexp_extract("source_file", r"\.([^.]+)$", 1)))


# ---- generation

_LONG = f"length({_strip('question')}) >= 15 AND length({_strip('answer')}) >= 25"
_LEANS, _ABOUT = (f"regexp_matches(coalesce(question, ''), '(?i){_q(p)}')" for p in (CONTEXT_DEPENDENT, ABOUT_THE_DOCUMENT))
_TYPE = f"CASE WHEN lower({_strip('question_type')}) IN ('factual', 'definitional', 'procedural') THEN lower({_strip('question_type')}) ELSE 'factual' END"


@query(f"""WITH {_PAIRS} SELECT CASE WHEN NOT ({_LONG}) THEN 'too_short' WHEN {_LEANS} THEN 'leans_on_passage' WHEN {_ABOUT} THEN 'about_the_document' ELSE 'passed' END AS gate, count(*) AS pairs FROM pairs GROUP BY 1""")
def question_gates(s: SparkSession, d: str) -> DataFrame:
    return generation.gate_report(_pairs(s, d, "question", "answer"))


@query(f"WITH {_PAIRS} SELECT {_TYPE} AS question_type, count(*) AS pairs FROM pairs GROUP BY 1")
def question_types_normalised(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d, "question_type").groupBy(normal_type(F.col("question_type")).alias("question_type")).agg(F.count("*").alias("pairs"))


@query(f"WITH {_WINDOWS} SELECT doc_id, coalesce({_name()}, '?') || '|' || coalesce(page, 0) || '|' || start_index AS key FROM windows JOIN (SELECT doc_id, page FROM documents) USING (doc_id)")
def chunk_keys(s: SparkSession, d: str) -> DataFrame:
    chunks = ingest.keep_chunks(ingest.window_chunks(table(s, d, "documents"), ["doc_id", "source", "page"], "text"))
    return chunks.select("doc_id", ingest.chunk_key(source_name(F.col("source")), F.col("page"), F.col("start_index")).alias("key"))


@query(f"WITH {_PAIRS} SELECT pair_id, {_strip('question')} AS question, md5({_strip('answer')}) AS answer_digest, {_TYPE} AS question_type FROM pairs WHERE {_LONG} AND NOT {_LEANS} AND NOT {_ABOUT} AND pair_id % 4 <> 3")
def parsed_responses(s: SparkSession, d: str) -> DataFrame:
    """Responses as models give them: bare, in a fence, amid prose, and cut off."""
    array = F.to_json(F.array(F.struct("question", "answer", "question_type")))
    kind = F.pmod("pair_id", F.lit(4))
    raw = F.when(kind == 0, array).when(kind == 1, F.concat(F.lit("```json\n"), array, F.lit("\n```"))).when(kind == 2, F.concat(F.lit("Here they are:\n"), array, F.lit("\nDone."))).otherwise(F.substring(array, F.lit(1), F.length(array) - 2))
    got = generation.parsed_pairs(_pairs(s, d, "question", "answer", "question_type").select("pair_id", raw.alias("raw")), keep=["pair_id"])
    return got.select("pair_id", "question", F.md5(F.col("answer").cast("binary")).alias("answer_digest"), "question_type")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id::VARCHAR) AS nth, count(*) OVER () AS n FROM documents) WHERE nth <= ceil(n * 0.1::DOUBLE)")
def abstention_hash_pick(s: SparkSession, d: str) -> DataFrame:
    return generation.pick_by_hash(table(s, d, "documents").select("doc_id"), F.col("doc_id"))


@query()
def abstention_exact_pick(s: SparkSession, d: str) -> DataFrame:
    return generation.pick_exact(table(s, d, "documents").select("doc_id"), [F.col("doc_id")])


@query(f"WITH {_PAIRS} SELECT {_TYPE} AS question_type, count_if(coalesce(answerable, true)) AS answerable_pairs, count_if(NOT coalesce(answerable, true)) AS unanswerable_pairs FROM pairs GROUP BY 1")
def generation_summary(s: SparkSession, d: str) -> DataFrame:
    return generation.generation_summary(_pairs(s, d, "question_type", "answerable").withColumns({"question_type": normal_type(F.col("question_type")), "answerable": or_true(F.col("answerable"))}))


# ---- judging


@query(f"SELECT {_G} AS groundedness, {_S} AS specificity, {_C} AS completeness, {_OUTCOME} AS outcome, {_KEEP} AS keep, count(*) AS pairs FROM rejected_pairs GROUP BY ALL")
def keep_decision(s: SparkSession, d: str) -> DataFrame:
    return judging.outcome_counts(table(s, d, "rejected_pairs"))


_BELOW = f"concat_ws(', ', CASE WHEN coalesce({_S}, 0) < 1 THEN 'specificity ' || coalesce({_S}, 0) || '/1' END, CASE WHEN coalesce({_C}, 0) < 1 THEN 'completeness ' || coalesce({_C}, 0) || '/1' END)"


@query(f"""SELECT CASE WHEN ({_TOTAL}) IS NULL THEN 'judge call failed - not assessed' WHEN {_KEEP} THEN NULL
  WHEN coalesce({_G}, 0) < 2 THEN 'UNGROUNDED (groundedness ' || coalesce({_G}, 0) || '/2): claims not traceable to passage'
  WHEN {_BELOW} <> '' THEN 'below floor on ' || {_BELOW} ELSE 'scored ' || ({_TOTAL}) || '/6, below threshold 4' END AS reason, count(*) AS pairs FROM rejected_pairs GROUP BY 1""")
def computed_reasons(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "rejected_pairs").groupBy(reject_reason(F.col("scores"), F.lit(None).cast("string")).alias("reason")).agg(F.count("*").alias("pairs"))


@query("SELECT substring(reject_reason, 1, 80) AS reason, count(*) AS pairs FROM rejected_pairs WHERE reject_reason IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def reject_reasons(s: SparkSession, d: str) -> DataFrame:
    return statistics.top_reasons(table(s, d, "rejected_pairs"))


@query(f"WITH {_PAIRS}, graded AS (SELECT answerable, quality_score FROM pairs UNION ALL SELECT answerable, quality_score FROM rejected_pairs) SELECT coalesce(answerable, true) AS answerable, count(*) AS pairs, count(quality_score) AS scored, sum(quality_score) AS score_sum FROM graded GROUP BY 1")
def validation_summary(s: SparkSession, d: str) -> DataFrame:
    both = _pairs(s, d, "answerable", "quality_score").select("answerable", "quality_score").unionByName(table(s, d, "rejected_pairs").select("answerable", "quality_score"))
    return statistics.summary_by_answerable(both)


@query("""SELECT md5(text) AS passage, count(*) AS pairs, min(doc_id) AS first_pair, max(doc_id) AS last_pair, sum(length(coalesce(source, ''))) AS question_chars, CASE WHEN count(*) <= 50 THEN 1 END AS batches FROM documents GROUP BY text""")
def judge_batches(s: SparkSession, d: str) -> DataFrame:
    """Documents stand for pairs and their texts for passages, as many texts come again."""
    docs = table(s, d, "documents").select(F.col("text").alias("chunk_text"), F.col("doc_id").alias("pair_ord"), F.coalesce("source", F.lit("")).alias("question"), F.col("lang").alias("answer"))
    batches = judging.passage_groups(docs)
    chars = F.aggregate("pairs", F.lit(0).cast("bigint"), lambda n, p: n + F.length(p["question"]))
    by = batches.groupBy("passage").agg(F.sum(F.size("pairs")).alias("pairs"), F.min(F.get("pairs", F.lit(0))["pair_ord"]).alias("first_pair"), F.max(F.element_at("pairs", -1)["pair_ord"]).alias("last_pair"), F.sum(chars).alias("question_chars"), F.count("*").alias("n"))
    return by.select(F.md5(F.col("passage").cast("binary")).alias("passage"), "pairs", "first_pair", "last_pair", "question_chars", F.when(F.col("pairs") <= 50, F.col("n")).alias("batches"))


@query("SELECT question, answer FROM rejected_pairs WHERE question NOT IN (SELECT question FROM unanswerable_pairs WHERE question IS NOT NULL) OR question IS NULL")
def open_judgements(s: SparkSession, d: str) -> DataFrame:
    """Pairs that no saved score exists for, by their question."""
    return judging.unscored(table(s, d, "rejected_pairs"), table(s, d, "unanswerable_pairs")).select("question", "answer")


@query(f"""WITH {_PAIRS}, either_kind AS (SELECT coalesce(answerable, true) AS answerable, true AS ok, true AS seen FROM pairs UNION ALL SELECT coalesce(answerable, true), false, quality_score IS NOT NULL FROM rejected_pairs)
SELECT answerable, count_if(ok) AS passed, count_if(seen) AS assessed, count_if(ok) * 1000 // greatest(count_if(seen), 1) AS pass_rate FROM either_kind GROUP BY 1""")
def validation_rates(s: SparkSession, d: str) -> DataFrame:
    return statistics.answerable_rates(_pairs(s, d, "answerable"), table(s, d, "rejected_pairs"))


_CHECK = """CASE WHEN abstention_check.unanswerable IS NULL OR abstention_check.plausible IS NULL OR abstention_check.abstention_answer IS NULL THEN 'not_assessed'
  WHEN abstention_check.unanswerable AND abstention_check.plausible AND abstention_check.abstention_answer THEN 'passed' ELSE 'failed' END"""


@query(f"""SELECT {_CHECK} AS outcome, CASE WHEN {_CHECK} = 'failed' THEN CASE WHEN NOT abstention_check.abstention_answer THEN 'answer is not the fixed abstention string'
  WHEN NOT abstention_check.unanswerable THEN 'passage does answer the question' ELSE 'question is off-topic or implausible' END END AS note, count(*) AS pairs FROM unanswerable_pairs GROUP BY ALL""")
def abstention_checks(s: SparkSession, d: str) -> DataFrame:
    c = F.col("abstention_check")
    return table(s, d, "unanswerable_pairs").groupBy(abstention_outcome(c).alias("outcome"), abstention_note(c).alias("note")).agg(F.count("*").alias("pairs"))


# ---- resuming

_LAST = "SELECT fingerprint, chunk_key AS key, payload FROM (SELECT *, row_number() OVER (PARTITION BY fingerprint, chunk_key ORDER BY log_ord DESC, appended_at DESC, payload DESC) AS nth FROM {}) WHERE nth = 1"
_ORDER = lambda: [F.col("log_ord"), F.col("appended_at")]


@query(_LAST.format("(SELECT * FROM checkpoint_log WHERE json_valid(payload))"))
def checkpoint_latest(s: SparkSession, d: str) -> DataFrame:
    return checkpoints.latest(table(s, d, "checkpoint_log"), _ORDER())


@query(_LAST.format("(SELECT * FROM checkpoint_log WHERE json_valid(payload) AND log_ord < (SELECT min(log_ord) FROM checkpoint_log WHERE payload IS NULL OR NOT json_valid(payload)))"))
def checkpoint_until_broken(s: SparkSession, d: str) -> DataFrame:
    return checkpoints.latest(table(s, d, "checkpoint_log"), _ORDER(), stop_at_broken=True)


@query("SELECT fingerprint, count(*) AS records, count_if(payload IS NULL OR NOT json_valid(payload)) AS broken, count(DISTINCT chunk_key) AS keys FROM checkpoint_log GROUP BY 1")
def checkpoint_summary(s: SparkSession, d: str) -> DataFrame:
    return checkpoints.summary(table(s, d, "checkpoint_log"))


@query("SELECT DISTINCT chunk_key AS key FROM checkpoint_log WHERE chunk_key NOT IN (SELECT chunk_key FROM checkpoint_log WHERE fingerprint = (SELECT min(fingerprint) FROM checkpoint_log) AND json_valid(payload))")
def resume_open_chunks(s: SparkSession, d: str) -> DataFrame:
    log = table(s, d, "checkpoint_log")
    run = log.agg(F.min("fingerprint")).first()[0]
    return checkpoints.open_work(log.select(F.col("chunk_key").alias("key")).distinct(), checkpoints.latest(log, _ORDER(), run))


@query(f"""WITH done AS ({_LAST.format("(SELECT * FROM checkpoint_log WHERE json_valid(payload))")})
SELECT fingerprint, count(*) AS calls, {", ".join(f"coalesce(sum((payload::JSON->>'$.{k}')::BIGINT), 0) AS {k}" for k in ("tokens", "pairs", "attempt"))} FROM done GROUP BY 1""")
def run_cost(s: SparkSession, d: str) -> DataFrame:
    return checkpoints.run_cost(checkpoints.latest(table(s, d, "checkpoint_log"), _ORDER()))


# ---- duplicates

_NUMBERS = "list_sort(list_distinct(list_transform(regexp_extract_all(coalesce({}, ''), '[0-9]+(?:[.,][0-9]+)*'), lambda x: replace(x, ',', ''))))"
_DOT = "list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"
_EDGES = f"edges AS MATERIALIZED (SELECT a.vec_id AS i, b.vec_id AS j, {_DOT} AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id < a.vec_id WHERE {_DOT} >= 0.35)"
_GREEDY = """near AS MATERIALIZED (SELECT i, list(j) AS js FROM edges {} GROUP BY i),
scan(pos, kept) AS (
  SELECT -1::BIGINT, []::BIGINT[]
  UNION ALL
  SELECT pos + 1, CASE WHEN js IS NOT NULL AND list_has_any(js, kept) THEN kept ELSE list_append(kept, pos + 1) END
  FROM scan LEFT JOIN near ON near.i = pos + 1 WHERE pos + 1 <= (SELECT max(vec_id) FROM embeddings)
),
stays AS (SELECT unnest(kept) AS vec_id FROM (SELECT kept FROM scan ORDER BY pos DESC LIMIT 1))"""


@query(f"WITH {_PAIRS} SELECT pair_id, array_to_string({_NUMBERS.format('answer')}, ' ') AS numbers FROM pairs")
def answer_number_sets(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d, "answer").select("pair_id", F.array_join(dedup.answer_numbers(F.col("answer")), " ").alias("numbers"))


def _embedding_edges(s: SparkSession, d: str, threshold: float = 0.35, guarded: bool = False) -> DataFrame:
    v = table(s, d, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 5 > 0, F.array((F.col("vec_id") % 5).cast("string"))).otherwise(F.array().cast("array<string>")).alias("nums"))
    return cut(dedup.similarity_edges(v, threshold, "vec_id", "embedding", "nums" if guarded else None))


@query(f"WITH {_EDGES} SELECT i, j, round(similarity, 4) AS similarity FROM edges")
def similarity_edges(s: SparkSession, d: str) -> DataFrame:
    return _embedding_edges(s, d).select("i", "j", F.round("similarity", 4).alias("similarity"))


def _kept(s: SparkSession, d: str, guarded: bool) -> DataFrame:
    gone = dedup.resolve(_embedding_edges(s, d, guarded=guarded))
    return table(s, d, "embeddings").select("vec_id").join(gone.withColumnRenamed("i", "vec_id"), "vec_id", "left_anti")


@query(f"WITH RECURSIVE {_EDGES}, {_GREEDY.format('')} SELECT vec_id FROM stays")
def greedy_dedup(s: SparkSession, d: str) -> DataFrame:
    return _kept(s, d, False)


@query(f"WITH RECURSIVE {_EDGES}, {_GREEDY.format('WHERE i % 5 = 0 OR j % 5 = 0 OR i % 5 = j % 5')} SELECT vec_id FROM stays")
def greedy_dedup_number_guard(s: SparkSession, d: str) -> DataFrame:
    return _kept(s, d, True)


@query(f"""WITH RECURSIVE {_EDGES}, {_GREEDY.format('')}
SELECT i, arg_max(j, (similarity, -j)) AS duplicate_of FROM edges WHERE i NOT IN (SELECT vec_id FROM stays) AND j IN (SELECT vec_id FROM stays) GROUP BY i""")
def dedup_matches(s: SparkSession, d: str) -> DataFrame:
    edges = _embedding_edges(s, d)
    return dedup.matches(edges, cut(dedup.resolve(edges))).select("i", "duplicate_of")


@query()
def dedup_lexical_overlap(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "duplicate_pairs").distinct()
    ratio = dedup.lexical_overlap(F.col("removed_question"), F.col("duplicate_of_question"))
    return rows.select("removed_question", "duplicate_of_question", ratio.alias("lexical_overlap"))


@query("""WITH known AS (SELECT round(similarity * 10000)::BIGINT AS s, lexical_overlap FROM duplicate_pairs WHERE similarity IS NOT NULL)
SELECT count(*) AS removed, min(s) AS least_similarity_1e4, max(s) AS most_similarity_1e4, count_if(lexical_overlap < 0.6) AS little_shared_wording, list_sort(list(s))[count(*) // 2 + 1] AS median_similarity_1e4 FROM known""")
def removed_summary(s: SparkSession, d: str) -> DataFrame:
    return dedup.removed_summary(table(s, d, "duplicate_pairs"))


_OPENER = "nullif(lower(array_to_string(regexp_extract_all(coalesce(question, ''), '[A-Za-z]+')[1:2], ' ')), '')"


@query(f"""WITH {_PAIRS}, o AS (SELECT {_OPENER} AS opener, count(*) AS n, min(pair_id) AS first FROM pairs WHERE {_OPENER} IS NOT NULL GROUP BY 1)
SELECT opener, n, (SELECT sum(n) FROM o) AS total, (SELECT count(*) FROM o) AS distinct_openers FROM o ORDER BY n DESC, first LIMIT 12""")
def opener_diversity(s: SparkSession, d: str) -> DataFrame:
    return dedup.opener_diversity(_pairs(s, d, "question"), F.col("pair_id"))


@query()
def dedup_pairs(s: SparkSession, d: str) -> DataFrame:
    pairs = _pairs(s, d).withColumn("vector", dedup.hashed_vector(dedup.dedup_text(F.col("question"), F.col("answer")), packed=True))
    return dedup.greedy_dedup(pairs, "pair_id", "vector")[1]


# ---- grounding

_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
_CONTENT = f"list_distinct(list_filter(regexp_extract_all(lower(coalesce({{}}, '')), '[a-z][a-z\\-'']+'), lambda w: length(w) > 2 AND NOT list_contains({_STOP}, w)))"
_VALUE = "try_cast(replace(x, ',', '') AS DOUBLE)"
_PLAIN = f"list_distinct(list_transform(list_filter(regexp_extract_all(coalesce({{}}, ''), '[0-9]+(?:[.,][0-9]+)*'), lambda x: {_VALUE} IS NOT NULL), lambda x: CASE WHEN {_VALUE} = floor({_VALUE}) THEN {_VALUE}::HUGEINT::VARCHAR ELSE {_VALUE}::VARCHAR END))"


@query(f"""WITH t AS (SELECT item_id, {_CONTENT.format("answer")} AS a, {_CONTENT.format("passage")} AS p, {_PLAIN.format("answer")} AS an, {_PLAIN.format("passage")} AS pn FROM eval_items),
m AS (SELECT *, len(a) AS answer_words, len(list_intersect(a, p)) AS matched_words, list_sort(list_filter(a, lambda w: NOT list_contains(p, w))) AS novel, list_sort(list_filter(an, lambda w: NOT list_contains(pn, w))) AS new FROM t)
SELECT item_id, answer_words, matched_words, len(novel) AS novel_word_count, array_to_string(novel[1:20], ' ') AS novel_words, array_to_string(list_sort(an), ' ') AS numbers, array_to_string(new, ' ') AS unsupported,
  CASE WHEN answer_words = 0 OR matched_words / answer_words >= 0.7 THEN 'strong' WHEN matched_words / answer_words >= 0.5 THEN 'moderate' ELSE 'weak' END AS grounding_band FROM m""")
def grounding_pairs(s: SparkSession, d: str) -> DataFrame:
    found = grounding.checked(table(s, d, "eval_items"))
    return found.select("item_id", F.col("answer_words").cast("bigint").alias("answer_words"), F.col("matched_words").cast("bigint").alias("matched_words"), F.col("novel_word_count").cast("bigint").alias("novel_word_count"), F.array_join("novel_words", " ").alias("novel_words"), F.array_join("numbers_in_answer", " ").alias("numbers"), F.array_join("unsupported_numbers", " ").alias("unsupported"), "grounding_band")


_PAGES = f"""pages AS (SELECT s, page, list_distinct(flatten(list({_CONTENT.format("text")}))) AS pw, list_distinct(flatten(list({_PLAIN.format("text")}))) AS pn FROM (SELECT {_name()} AS s, page, text FROM documents) WHERE s IS NOT NULL AND page IS NOT NULL GROUP BY s, page)"""
_FOUND = f"""found AS (
  SELECT pair_id, quality_score, question_type, s AS name, pw IS NOT NULL AS passage_found, len(a) AS answer_words, coalesce(len(list_intersect(a, pw)), 0) AS matched_words, len(an) AS answer_numbers, coalesce(len(list_intersect(an, pn)), 0) AS matched_numbers
  FROM (SELECT pair_id, quality_score, question_type, {_name()} AS s, page, {_CONTENT.format("answer")} AS a, {_PLAIN.format("answer")} AS an FROM pairs WHERE coalesce(answerable, true)) LEFT JOIN pages USING (s, page)
)"""
_BY_PAGE = f"WITH {_PAIRS}, {_PAGES}, {_FOUND}"
_RAW = "CASE WHEN answer_words = 0 THEN 1.0::DOUBLE ELSE matched_words::DOUBLE / answer_words END"


def _by_page(s: SparkSession, d: str) -> DataFrame:
    pairs = _pairs(s, d, "answer", "source", "page", "question_type", "answerable", "quality_score").filter(or_true(F.col("answerable")))
    named = pairs.withColumn("name", source_name(F.col("source")))
    return grounding.with_findings(grounding.checked_by_page(named, table(s, d, "documents"), "pair_id", ["quality_score", "question_type", "name"]))


@query(f"{_BY_PAGE} SELECT pair_id, passage_found, answer_words, matched_words, answer_numbers, matched_numbers FROM found")
def grounding_dataset(s: SparkSession, d: str) -> DataFrame:
    return _by_page(s, d).select("pair_id", "passage_found", "answer_words", "matched_words", "answer_numbers", "matched_numbers")


@query(f"""{_BY_PAGE} SELECT count(*) AS analysed, count_if(r >= 0.7) AS strong, count_if(r >= 0.5 AND r < 0.7) AS moderate, count_if(r < 0.5) AS weak, count_if(matched_numbers < answer_numbers) AS with_unsupported_numbers,
  sum(round(round(r, 3) * 1000)::BIGINT) AS overlap_sum_1e3, min(round(round(r, 3) * 1000)::BIGINT) AS least_overlap_1e3 FROM (SELECT *, {_RAW} AS r FROM found WHERE passage_found)""")
def grounding_summary(s: SparkSession, d: str) -> DataFrame:
    return grounding.summary(_by_page(s, d).filter("passage_found"))


@query(f"{_BY_PAGE}, b AS (SELECT least(floor(round({_RAW}, 3) * 10), 9)::INT AS bin, count(*) AS n FROM found WHERE passage_found GROUP BY 1) SELECT i::INT AS bin, coalesce(n, 0) AS n FROM range(10) r(i) LEFT JOIN b ON b.bin = i")
def grounding_histogram(s: SparkSession, d: str) -> DataFrame:
    return grounding.histogram(_by_page(s, d).filter("passage_found"))


@query(f"{_BY_PAGE} SELECT question_type, count(*) AS pairs, round(avg(round({_RAW}, 3)), 3) AS mean_overlap FROM (SELECT * REPLACE ({_TYPE} AS question_type) FROM found WHERE passage_found) GROUP BY 1")
def grounding_by_type(s: SparkSession, d: str) -> DataFrame:
    return grounding.mean_overlap(_by_page(s, d).filter("passage_found").withColumn("question_type", normal_type(F.col("question_type"))), "question_type")


@query(f"{_BY_PAGE} SELECT name, count(*) AS pairs, round(avg(round({_RAW}, 3)), 3) AS mean_overlap FROM found WHERE passage_found GROUP BY 1")
def grounding_by_source(s: SparkSession, d: str) -> DataFrame:
    return grounding.mean_overlap(_by_page(s, d).filter("passage_found"), "name")


@query(f"{_BY_PAGE} SELECT count_if(passage_found) AS analysed, count_if(NOT passage_found) AS not_matched FROM found")
def grounding_coverage(s: SparkSession, d: str) -> DataFrame:
    return grounding.coverage(_by_page(s, d))


@query(f"{_BY_PAGE} SELECT pair_id, answer_numbers, matched_numbers FROM found WHERE passage_found AND matched_numbers < answer_numbers")
def unsupported_number_list(s: SparkSession, d: str) -> DataFrame:
    return explorer.unsupported_numbers(_by_page(s, d)).select("pair_id", "answer_numbers", "matched_numbers")


@query(f"{_BY_PAGE} SELECT pair_id, round({_RAW}, 3) AS lexical_overlap FROM found WHERE passage_found ORDER BY 2, 1 LIMIT 15")
def lowest_overlap(s: SparkSession, d: str) -> DataFrame:
    return explorer.lowest_overlap(_by_page(s, d), [F.col("pair_id")]).select("pair_id", "lexical_overlap")


@query(f"{_BY_PAGE} SELECT pair_id, quality_score, round({_RAW}, 3) AS lexical_overlap FROM found WHERE passage_found AND quality_score IS NOT NULL")
def judge_overlap_points(s: SparkSession, d: str) -> DataFrame:
    return explorer.judged_and_matched(_by_page(s, d)).select("pair_id", "quality_score", "lexical_overlap")


@query(f"""{_BY_PAGE}, m AS (SELECT {_TYPE} AS question_type, avg(round({_RAW}, 3)) AS m, count(*) AS pairs FROM found WHERE passage_found GROUP BY 1)
SELECT question_type, pairs FROM m ORDER BY m, question_type LIMIT 1""")
def weakest_type(s: SparkSession, d: str) -> DataFrame:
    return explorer.weakest_type(_by_page(s, d).filter("passage_found").withColumn("question_type", normal_type(F.col("question_type"))))


@query(f"""WITH {_PAGES}, items AS (SELECT item_id, answer, CASE WHEN item_id % 3 > 0 THEN nullif(passage, '') END AS own, d.s, d.page FROM eval_items LEFT JOIN (SELECT doc_id, {_name()} AS s, page FROM documents) d ON d.doc_id = item_id),
f AS (SELECT item_id, own IS NOT NULL AS has_own, pw IS NOT NULL AS has_page, {_CONTENT.format("answer")} AS a, CASE WHEN own IS NOT NULL THEN {_CONTENT.format("own")} ELSE pw END AS w FROM items LEFT JOIN pages USING (s, page))
SELECT item_id, CASE WHEN has_own THEN 'own' WHEN has_page THEN 'page' ELSE 'none' END AS passage_from, len(a) AS answer_words, coalesce(len(list_intersect(a, w)), 0) AS matched_words FROM f""")
def passage_resolution(s: SparkSession, d: str) -> DataFrame:
    """Two in three held-out items hold their passage; the others are looked up, at the place of a document with their number."""
    docs = table(s, d, "documents")
    place = docs.select(F.col("doc_id").alias("item_id"), "source", "page")
    items = table(s, d, "eval_items").withColumn("chunk_text", F.when(F.col("item_id") % 3 > 0, F.col("passage"))).join(place, "item_id", "left")
    return grounding.checked_either(items, docs, "item_id").select("item_id", "passage_from", "answer_words", "matched_words")


@query(f"""{_BY_PAGE}, j AS (SELECT round({_RAW}, 3) AS o, quality_score = 6 AS clean FROM found WHERE passage_found AND quality_score IS NOT NULL)
SELECT count(*) AS judged, count_if(clean = (o >= 0.7)) AS agree, count_if(clean AND o < 0.5) AS clean_but_low, count_if(NOT clean AND o >= 0.7) AS flagged_but_high FROM j""")
def judge_vs_mechanical(s: SparkSession, d: str) -> DataFrame:
    """Only full marks surely mean full groundedness in the pairs that stayed."""
    score = F.when(F.col("quality_score").isNotNull(), F.when(F.col("quality_score") == 6, 2).otherwise(1))
    return grounding.judge_agreement(_by_page(s, d).filter("passage_found"), score)


# ---- statistics

_COUNTS = f"""WITH {_PAIRS}, one AS (
  SELECT (SELECT count(*) FROM pairs) AS final, (SELECT count_if(NOT coalesce(answerable, true)) FROM pairs) AS final_unanswerable, count(*) AS rejected, count_if(quality_score IS NULL AND coalesce(answerable, true)) AS unassessed,
    count_if(NOT coalesce(answerable, true)) AS rejected_unanswerable, count_if(reject_reason = 'judge call failed - not assessed') AS judge_failures, count_if(starts_with(reject_reason, 'UNGROUNDED')) AS ungrounded, (SELECT count(*) FROM duplicate_pairs) AS duplicates
  FROM rejected_pairs
), counted AS (SELECT *, final + duplicates AS validated, final + duplicates + rejected AS raw, greatest(final + duplicates + rejected - unassessed, 1) AS assessed FROM one)"""


@query(f"{_COUNTS} SELECT * FROM counted")
def stats_counts(s: SparkSession, d: str) -> DataFrame:
    return statistics.counts(_pairs(s, d, "answerable"), table(s, d, "rejected_pairs"), table(s, d, "duplicate_pairs"))


@query(f"""{_COUNTS} SELECT validated * 1000 // assessed AS pass_rate, duplicates * 1000 // greatest(validated, 1) AS duplicate_rate, final * 1000 // greatest(raw, 1) AS yield_rate, unassessed * 1000 // greatest(raw, 1) AS unassessed_rate, judge_failures = 0 AS complete FROM counted""")
def stats_rates(s: SparkSession, d: str) -> DataFrame:
    return statistics.rates(stats_counts(s, d))


@query(f"WITH {_PAIRS} SELECT count(quality_score) AS scored, sum(quality_score) AS score_sum, min(quality_score) AS least, max(quality_score) AS most FROM pairs")
def quality_stats(s: SparkSession, d: str) -> DataFrame:
    return statistics.quality(_pairs(s, d, "quality_score"))


@query(f"WITH {_PAIRS} SELECT quality_score, count(*) AS pairs FROM pairs GROUP BY 1")
def score_distribution(s: SparkSession, d: str) -> DataFrame:
    return statistics.score_distribution(_pairs(s, d, "quality_score"))


@query(f"WITH {_PAIRS}, g AS (SELECT quality_score FROM pairs UNION ALL SELECT quality_score FROM rejected_pairs) SELECT quality_score, count(*) AS pairs FROM g WHERE quality_score IS NOT NULL GROUP BY 1")
def graded_score_histogram(s: SparkSession, d: str) -> DataFrame:
    both = _pairs(s, d, "quality_score").select("quality_score").unionByName(table(s, d, "rejected_pairs").select("quality_score"))
    return statistics.score_distribution(both.filter("quality_score is not null"))


@query(f"""WITH {_PAIRS}, k AS (SELECT chunk_key, bool_and(payload IS NULL OR NOT json_valid(payload)) AS failed FROM checkpoint_log GROUP BY 1), o AS (SELECT count(*) AS chunks, count_if(failed) AS failed_chunks, (SELECT count(*) FROM pairs) AS pairs FROM k)
SELECT *, failed_chunks * 1000 // greatest(chunks, 1) AS failed_share, pairs * 100 // greatest(chunks, 1) AS pairs_a_chunk_1e2 FROM o""")
def chunk_rates(s: SparkSession, d: str) -> DataFrame:
    return statistics.per_chunk(table(s, d, "checkpoint_log"), checkpoints.broken(F.col("payload")), _pairs(s, d, "page"))


@query(f"""WITH {_PAIRS} SELECT count(*) AS requested, count(*) AS generated, count_if({_CHECK} = 'passed') AS verified, (SELECT count_if(NOT coalesce(answerable, true)) FROM pairs) AS in_dataset, count_if({_CHECK} = 'failed') AS failed FROM unanswerable_pairs""")
def abstention_block(s: SparkSession, d: str) -> DataFrame:
    return statistics.abstention_block(table(s, d, "unanswerable_pairs"), _pairs(s, d, "answerable"))


@query(f"""SELECT question, source, page, in_dataset, {_CHECK} AS outcome, CASE WHEN {_CHECK} = 'failed' THEN CASE WHEN NOT abstention_check.abstention_answer THEN 'answer is not the fixed abstention string'
  WHEN NOT abstention_check.unanswerable THEN 'passage does answer the question' ELSE 'question is off-topic or implausible' END END AS note FROM unanswerable_pairs""")
def abstention_table(s: SparkSession, d: str) -> DataFrame:
    return explorer.abstention_table(table(s, d, "unanswerable_pairs"))


@query("SELECT criterion, count(*) AS pairs, sum(score) AS score_sum, round(avg(score), 3) AS mean_score FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS criterion, scores.{k} AS score FROM rejected_pairs" for k in ("groundedness", "specificity", "completeness")) + ") WHERE score IS NOT NULL GROUP BY 1")
def sub_scores(s: SparkSession, d: str) -> DataFrame:
    return statistics.sub_scores(table(s, d, "rejected_pairs"))


@query(f"WITH {_PAIRS} SELECT {_name()} AS source, count(*) AS pairs FROM pairs GROUP BY 1")
def pairs_per_source(s: SparkSession, d: str) -> DataFrame:
    return statistics.per_source(_pairs(s, d, "source"))


@query(f"WITH {_PAIRS} SELECT lower(trim(question_type, ' ')) AS question_type, count(*) AS pairs FROM pairs GROUP BY 1")
def pairs_per_type(s: SparkSession, d: str) -> DataFrame:
    return statistics.per_type(_pairs(s, d, "question_type"))


@query(f"WITH {_PAIRS} SELECT {_CHECK} AS check_outcome, in_dataset, question IN (SELECT question FROM pairs WHERE question IS NOT NULL) AS now_in_dataset, count(*) AS pairs FROM unanswerable_pairs GROUP BY ALL")
def abstention_in_dataset(s: SparkSession, d: str) -> DataFrame:
    return statistics.abstention_report(table(s, d, "unanswerable_pairs"), _pairs(s, d, "question")).groupBy("check_outcome", "in_dataset", "now_in_dataset").agg(F.count("*").alias("pairs"))


_CLINIC = " OR ".join(f"contains(lower(coalesce(source, '')), '{k}')" for k in statistics.CLINICAL)


@query(f"""WITH {_PAIRS} SELECT pair_id, 'system,user,assistant' AS roles, (SELECT CASE WHEN bool_or({_CLINIC}) THEN '{_q(statistics.CLINICAL_SYSTEM)}' ELSE '{_q(statistics.SYSTEM)}' END FROM pairs) AS system, question AS user_turn, answer AS assistant_turn, coalesce(answerable, true) AS answerable FROM pairs""")
def chatml_records(s: SparkSession, d: str) -> DataFrame:
    m = statistics.with_messages(_pairs(s, d, "question", "answer", "source", "answerable"))
    return m.select("pair_id", F.array_join(F.transform("messages", lambda x: x["role"]), ",").alias("roles"), F.col("messages")[0]["content"].alias("system"), F.col("messages")[1]["content"].alias("user_turn"), F.col("messages")[2]["content"].alias("assistant_turn"), or_true(F.col("answerable")).alias("answerable"))


@query(f"WITH {_PAIRS} SELECT {', '.join(EXPORT_FIELDS)} FROM pairs")
def clean_projection(s: SparkSession, d: str) -> DataFrame:
    out = statistics.clean_records(_pairs(s, d))
    statistics.assert_no_internals(out)
    return out


# ---- sweeps and agreement

_VARIANTS = " UNION ALL ".join(f"SELECT {m} AS min_score, {str(on).lower()} AS floors, coalesce(total >= {m}{' AND fl' if on else ''}, false) AS keep, total, opener FROM g" for m in sweeps.MIN_SCORES for on in (True, False))


@query(f"""WITH g AS (SELECT ({_TOTAL}) AS total, ({_FLOORS}) AS fl, {_OPENER} AS opener FROM rejected_pairs WHERE ({_TOTAL}) IS NOT NULL), v AS ({_VARIANTS})
SELECT min_score, floors, count(*) AS graded, count_if(keep) AS passed, coalesce(sum(total) FILTER (keep), 0) AS score_sum, count(DISTINCT opener) FILTER (keep) AS unique_openers FROM v GROUP BY 1, 2""")
def threshold_sweep(s: SparkSession, d: str) -> DataFrame:
    return sweeps.threshold_sweep(table(s, d, "rejected_pairs"))


_SWEPT = (0.30, 0.35, 0.40)


@query()
def swept_dedup(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "rejected_pairs").filter("scores is not null").distinct()
    graded = with_ordinal(rows, [F.col("question"), F.col("answer"), F.col("source"), F.col("page"), F.col("reject_reason")])
    return sweeps.swept_dedup(cut(graded.withColumn("vector", dedup.hashed_vector(dedup.dedup_text(F.col("question"), F.col("answer"))))), "ord", "vector")


def _sweep_sql() -> tuple[str, str]:
    """The recursive scan, once per threshold, and what is counted of it."""
    parts, picks = [_EDGES.replace("0.35", str(min(_SWEPT)))], []
    for k, t in enumerate(_SWEPT):
        own = _GREEDY.format(f"WHERE similarity >= {t}")
        for name in ("near", "scan", "stays"):
            own = own.replace(f"{name} ", f"{name}{k} ").replace(f"{name}(", f"{name}{k}(").replace(f"{name}.", f"{name}{k}.")
        parts.append(own)
        picks.append(f"SELECT {t}::DOUBLE AS threshold, (SELECT count(*) FROM stays{k}) AS survivors, (SELECT count(*) FROM embeddings) - (SELECT count(*) FROM stays{k}) AS removed")
    return "WITH RECURSIVE " + ", ".join(parts), " UNION ALL ".join(picks)


@query(" ".join(_sweep_sql()))
def dedup_sweep(s: SparkSession, d: str) -> DataFrame:
    return sweeps.dedup_sweep(table(s, d, "embeddings"), "vec_id", "embedding", _SWEPT)


def _removals_sql() -> str:
    """Per threshold, the three removals that resemble their match least."""
    picks = []
    for k, t in enumerate(_SWEPT):
        own = f"SELECT i, arg_max(j, (similarity, -j)) AS duplicate_of, max(similarity) AS s FROM edges WHERE similarity >= {t} AND i NOT IN (SELECT vec_id FROM stays{k}) AND j IN (SELECT vec_id FROM stays{k}) GROUP BY i"
        picks.append(f"SELECT {t}::DOUBLE AS threshold, i, duplicate_of, round(s, 4) AS similarity, nth FROM (SELECT *, row_number() OVER (ORDER BY s, i) AS nth FROM ({own})) WHERE nth <= 3")
    return _sweep_sql()[0] + " " + " UNION ALL ".join(picks)


@query(_removals_sql())
def least_similar_removals(s: SparkSession, d: str) -> DataFrame:
    edges = _embedding_edges(s, d, min(_SWEPT))
    return sweeps.least_similar_removals(edges, _SWEPT).select("threshold", "i", "duplicate_of", F.round("similarity", 4).alias("similarity"), F.col("nth").cast("bigint").alias("nth"))


_RATED = """rated AS (SELECT doc_id, min(l) FILTER (side = 'a') AS a, min(l) FILTER (side = 'b') AS b FROM (
  SELECT doc_id, substring(rater, 7, 1) AS side, CASE lower(trim(category)) WHEN 'none' THEN 0 WHEN 'abusive' THEN 1 WHEN 'hateful' THEN 2 WHEN 'sexual' THEN 3 END AS l FROM content_labels) GROUP BY doc_id)"""


def _rated(s: SparkSession, d: str) -> DataFrame:
    """The labels of raters a and b as whole numbers, a row per document."""
    low = F.lower(F.trim("category"))
    label = F.when(low == "none", 0).when(low == "abusive", 1).when(low == "hateful", 2).when(low == "sexual", 3)
    side = F.substring("rater", 7, 1)
    t = table(s, d, "content_labels")
    return t.groupBy("doc_id").agg(F.min(F.when(side == "a", label)).alias("a"), F.min(F.when(side == "b", label)).alias("b"))


@query(f"""WITH {_RATED}, t AS (SELECT a AS x, b AS y, count(*) AS n FROM rated WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2),
m AS (SELECT sum(n)::BIGINT AS n, coalesce(sum(n) FILTER (x = y), 0)::BIGINT AS agree, sum(n * (x - y) * (x - y))::DOUBLE AS wo FROM t),
g AS (SELECT r.x, c.y, r.rn, c.cn FROM (SELECT x, sum(n) AS rn FROM t GROUP BY x) r, (SELECT y, sum(n) AS cn FROM t GROUP BY y) c),
e AS (SELECT sum(rn * cn) FILTER (x = y) AS ch, sum(rn * cn * (x - y) * (x - y))::DOUBLE AS we, count(DISTINCT x) AS kx, count(DISTINCT y) AS ky FROM g)
SELECT coalesce(n, 0) AS n, agree, least(kx, ky) < 2 AS constant, CASE WHEN least(kx, ky) >= 2 THEN round((agree / n::DOUBLE - coalesce(ch, 0) / (n::DOUBLE * n)) / (1 - coalesce(ch, 0) / (n::DOUBLE * n)), 6) END AS kappa,
  CASE WHEN least(kx, ky) >= 2 THEN round(1 - wo * n / we, 6) END AS weighted_kappa FROM m, e""")
def cohen_kappa(s: SparkSession, d: str) -> DataFrame:
    return agreement.kappa(_rated(s, d), "a", "b")


def _one_kappa(k: int) -> str:
    """Kappa of two raters who say whether a document is of category k."""
    return f"""SELECT {k} AS criterion, CASE WHEN min(x) < max(x) AND min(y) < max(y) THEN round((avg((x = y)::INT) - (avg(x) * avg(y) + (1 - avg(x)) * (1 - avg(y)))) / (1 - (avg(x) * avg(y) + (1 - avg(x)) * (1 - avg(y)))), 6) END AS kappa
  FROM (SELECT (a = {k})::INT AS x, (b = {k})::INT AS y FROM rated WHERE a IS NOT NULL AND b IS NOT NULL)"""


@query(f"""WITH {_RATED}, k AS ({" UNION ALL ".join(map(_one_kappa, range(4)))})
SELECT criterion, kappa, CASE WHEN kappa < 0 THEN 'none' WHEN kappa <= 0.2 THEN 'slight' WHEN kappa <= 0.4 THEN 'fair' WHEN kappa <= 0.6 THEN 'moderate' WHEN kappa <= 0.8 THEN 'substantial' ELSE 'almost perfect' END AS strength, kappa < 0.4 AS warn
FROM k WHERE kappa IS NOT NULL ORDER BY kappa, criterion LIMIT 1""")
def weakest_kappa(s: SparkSession, d: str) -> DataFrame:
    """The category on which two raters agree least."""
    rated = cut(_rated(s, d))
    each = [agreement.kappa(rated.select((F.col("a") == k).cast("int").alias("a"), (F.col("b") == k).cast("int").alias("b")), "a", "b").withColumn("criterion", F.lit(k)) for k in range(4)]
    return explorer.weakest_kappa(each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3]))


@query(f"""WITH {_RATED}, v AS (SELECT a >= 2 AS x, b >= 2 AS y FROM rated WHERE a IS NOT NULL AND b IS NOT NULL) SELECT count(*) AS n, count_if(x = y) AS agree FROM v""")
def keep_agreement(s: SparkSession, d: str) -> DataFrame:
    """The keep rule on two raters' labels, read as a groundedness of 2 from label 2 on, with full marks elsewhere."""
    score = lambda c: F.when(c.isNotNull(), F.struct(F.when(c >= 2, 2).otherwise(1).alias("groundedness"), F.lit(2).alias("specificity"), F.lit(2).alias("completeness")))
    rated = _rated(s, d).filter("a is not null and b is not null")
    return agreement.keep_agreement(rated.select(score(F.col("a")).alias("x"), score(F.col("b")).alias("y")), "x", "y").select("n", "agree")


@query("""SELECT date_trunc('hour', appended_at) AS hour, fingerprint, count(*) AS calls FROM checkpoint_log WHERE appended_at IS NOT NULL GROUP BY 1, 2""")
def hourly_calls(s: SparkSession, d: str) -> DataFrame:
    return hourly_counts(table(s, d, "checkpoint_log").filter("appended_at is not null")).select(F.col("window.start").alias("hour"), "fingerprint", "calls")


@query(f"WITH {_RATED} SELECT 'a' AS rater, count(DISTINCT a) AS labels, count(DISTINCT a) < 2 AS constant FROM rated UNION ALL SELECT 'b', count(DISTINCT b), count(DISTINCT b) < 2 FROM rated")
def constant_raters(s: SparkSession, d: str) -> DataFrame:
    return agreement.constant_raters(_rated(s, d), ["a", "b"])


@query()
def seeded_sample(s: SparkSession, d: str) -> DataFrame:
    return agreement.seeded_sample(_pairs(s, d, "question", "page", "quality_score").filter("quality_score is not null"), [F.col("question"), F.col("page"), F.col("pair_id")]).select("draw", "pair_id")


# ---- reading


@query(f"WITH {_PAIRS} SELECT pair_id FROM pairs WHERE (coalesce(answerable, true) AND coalesce(quality_score, 0) >= 4 AND question_type IN ('factual', 'procedural')) OR (NOT coalesce(answerable, true) AND question_type IN ('factual', 'procedural'))")
def explorer_filter(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d, "answerable", "quality_score", "question_type").filter(explorer.explorer_filter(4, ["answerable", "abstention"], ["factual", "procedural"])).select("pair_id")


@query(f"WITH {_PAIRS} SELECT pair_id FROM pairs WHERE regexp_matches(lower(coalesce(question, '')), 'moisture|dryer') OR regexp_matches(lower(coalesce(answer, '')), 'moisture|dryer')")
def explorer_search(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d, "question", "answer").filter(explorer.search("Moisture|Dryer")).select("pair_id")


@query(f"WITH {_PAIRS} SELECT ord, pair_id, question FROM (SELECT row_number() OVER (ORDER BY pair_id) - 1 AS ord, pair_id, question FROM pairs) WHERE ord >= 50 AND ord < 75")
def explorer_page(s: SparkSession, d: str) -> DataFrame:
    return explorer.page_of(_pairs(s, d, "question").select("pair_id", "question"), [F.col("pair_id")], 2)


@query(f"WITH {_PAIRS} SELECT count(*) AS all_pairs, count_if(coalesce(answerable, true) AND coalesce(quality_score, 0) >= 5) AS shown, count_if(coalesce(answerable, true) AND quality_score >= 5) AS scored, coalesce(sum(quality_score) FILTER (coalesce(answerable, true) AND quality_score >= 5), 0) AS score_sum FROM pairs")
def view_metrics(s: SparkSession, d: str) -> DataFrame:
    return explorer.view_metrics(_pairs(s, d, "answerable", "quality_score"), explorer.explorer_filter(5, ["answerable"]))


@query("SELECT question, answer, quality_score, reject_reason FROM rejected_pairs WHERE quality_score IS NOT NULL ORDER BY quality_score, question, answer, reject_reason NULLS FIRST LIMIT 20")
def worst_rejected(s: SparkSession, d: str) -> DataFrame:
    return explorer.worst_rejected(table(s, d, "rejected_pairs"), [F.col("question"), F.col("answer"), F.col("reject_reason")]).select("question", "answer", "quality_score", "reject_reason")


@query(f"WITH {_PAIRS} SELECT pair_id, quality_score FROM pairs ORDER BY quality_score DESC NULLS LAST, pair_id LIMIT 20")
def best_kept(s: SparkSession, d: str) -> DataFrame:
    return explorer.best_kept(_pairs(s, d, "quality_score"), [F.col("pair_id")]).select("pair_id", "quality_score")


@query("SELECT criterion, score, count(*) AS pairs FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS criterion, scores.{k} AS score FROM rejected_pairs" for k in ("groundedness", "specificity", "completeness")) + ") WHERE score IN (0, 1) GROUP BY 1, 2")
def criterion_crosstab(s: SparkSession, d: str) -> DataFrame:
    return explorer.criterion_crosstab(table(s, d, "rejected_pairs"))


@query("SELECT removed_question, removed_answer, similarity FROM duplicate_pairs WHERE similarity IS NOT NULL ORDER BY similarity DESC, removed_question, removed_answer NULLS FIRST LIMIT 25")
def closest_duplicates(s: SparkSession, d: str) -> DataFrame:
    return explorer.closest_duplicates(table(s, d, "duplicate_pairs"), [F.col("removed_question"), F.col("removed_answer")]).select("removed_question", "removed_answer", "similarity")


@query("SELECT question, arg_min(passage, item_id) AS passage FROM eval_items WHERE passage <> '' GROUP BY question")
def passage_lookup(s: SparkSession, d: str) -> DataFrame:
    return explorer.passages_by_question(table(s, d, "eval_items"), "passage", F.col("item_id"))


@query(f"{_COUNTS} SELECT unnest(['1 raw', '2 judged', '3 deduplicated']) AS stage, unnest([raw, validated, final]) AS pairs, unnest([1000 * raw // greatest(raw, 1), validated * 1000 // greatest(raw, 1), final * 1000 // greatest(raw, 1)]) AS share FROM counted")
def survival_funnel(s: SparkSession, d: str) -> DataFrame:
    return stats_counts(s, d).select(F.explode(explorer.survival_funnel(F.col("raw"), F.col("validated"), F.col("final"))).alias("f")).select("f.*")


@query(f"WITH {_PAIRS}, g AS (SELECT quality_score AS q FROM pairs UNION ALL SELECT quality_score FROM rejected_pairs) SELECT count(q) AS scored, count_if(q = 6) AS full, count(DISTINCT q) AS scores_used, count_if(q = 6) * 4 > count(q) * 3 AS lenient FROM g")
def judge_leniency(s: SparkSession, d: str) -> DataFrame:
    return explorer.leniency(_pairs(s, d, "quality_score").select("quality_score").unionByName(table(s, d, "rejected_pairs").select("quality_score")))


@query("SELECT count(*) AS sampled, count(l.doc_id) AS labelled, min(d.doc_id) FILTER (l.doc_id IS NULL) AS first_open FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM content_labels WHERE category IS NOT NULL) l ON l.doc_id = d.doc_id")
def labelled_progress(s: SparkSession, d: str) -> DataFrame:
    return explorer.labelled_progress(table(s, d, "documents").select("doc_id"), table(s, d, "content_labels").filter("category is not null"), "doc_id")


@query(f"WITH {_PAIRS} SELECT DISTINCT {_name()} AS source FROM pairs WHERE {_name()} IS NOT NULL")
def distinct_sources(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d, "source").select(source_name(F.col("source")).alias("source")).filter("source is not null").distinct()


# ---- cost and progress

_SIZES = f"sizes AS (SELECT {_name()} AS source_file, count(*) AS chunks FROM documents GROUP BY 1)"


def _sizes(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").groupBy(source_name(F.col("source")).alias("source_file")).agg(F.count("*").alias("chunks"))


@query(f"""WITH {_SIZES}, t AS (SELECT source_file, chunks, chunks * 3 AS estimated_pairs, floor(chunks * 860 + chunks * 0.1::DOUBLE * 680)::BIGINT AS generation_tokens, (chunks * 780)::BIGINT AS judge_tokens, floor(chunks * 2 + chunks * 0.1::DOUBLE * 2)::BIGINT AS requests FROM sizes)
SELECT *, generation_tokens + judge_tokens AS total_tokens, generation_tokens + judge_tokens > 200000 AS over_budget, round((generation_tokens + judge_tokens) / 200000::DOUBLE * 100, 1) AS daily_token_share, round((generation_tokens + judge_tokens) / 8000::DOUBLE + 35::DOUBLE / 60, 1) AS least_minutes FROM t""")
def cost_table(s: SparkSession, d: str) -> DataFrame:
    return _sizes(s, d).withColumns(budget.run_cost(F.col("chunks")))


@query(f"WITH {_SIZES} SELECT source_file, greatest(0, floor(chunks * 1000 / (860 + 680 * 0.1::DOUBLE + 450 + 330)))::BIGINT AS affordable FROM sizes")
def affordable_chunks(s: SparkSession, d: str) -> DataFrame:
    return _sizes(s, d).select("source_file", budget.affordable_chunks(F.col("chunks") * 1000).alias("affordable"))


@query("SELECT doc_id, sum(coalesce(n_chars, 0)) OVER (ORDER BY doc_id) AS spent, sum(coalesce(n_chars, 0)) OVER (ORDER BY doc_id) <= 200000 AS within FROM documents")
def budget_running_spend(s: SparkSession, d: str) -> DataFrame:
    return budget.running_spend(table(s, d, "documents").select("doc_id", "n_chars"), [F.col("doc_id")], F.col("n_chars"), 200_000).select("doc_id", "spent", "within")


@query(f"""WITH {_SIZES}, p AS (SELECT source_file, chunks, 35.0::DOUBLE + chunks * 1.6::DOUBLE AS ingest, chunks * 5.4::DOUBLE AS generate, chunks * 4.8::DOUBLE AS validate FROM sizes)
SELECT source_file, round(ingest + generate + validate + 16, 3) AS total, round((ingest + 0.5::DOUBLE * generate) / (ingest + generate + validate + 16) * 100, 1) AS percent FROM p""")
def progress_plan(s: SparkSession, d: str) -> DataFrame:
    plan = budget.plan_seconds(F.col("chunks"), F.col("chunks"))
    return _sizes(s, d).select("source_file", F.round(plan["total"], 3).alias("total"), budget.overall_percent(plan, "generate", F.lit(1), F.lit(2)).alias("percent"))


def entry(s: SparkSession, d: str) -> DataFrame:
    """Pairs by source with their outcome, kept, rejected or not assessed."""
    kept = _pairs(s, d, "source").select("source", F.lit("kept").alias("outcome"))
    graded = table(s, d, "rejected_pairs").select("source", F.when(F.col("quality_score").isNull(), "not_assessed").otherwise("rejected").alias("outcome"))
    return kept.unionByName(graded).groupBy(source_name(F.col("source")).alias("source"), "outcome").agg(F.count("*").alias("pairs"))

