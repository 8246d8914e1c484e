"""One query per operator over its whole table, with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import (
    compression_classifier,
    conversation_repair,
    decontaminate,
    html_extract,
    kneser_ney,
    labelled,
    mixing,
    ngram_join,
    quality_rules,
    source_divergence,
    substring_dedup,
    token_records,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Arrow batches of texts: this many rows cross to Python at a time.
BATCH_ROWS = "512"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(settings(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def settings(spark: SparkSession) -> SparkSession:
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 1 -----------------------------------------------------------------------


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents"), n=3, threshold=0.9)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"

ORACLES["op1_ngram_jaccard_join"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS inter FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * inter >= 90 * (nx.n + ny.n - inter)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM w
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT w.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(reach.y) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN reach ON reach.x = w.doc_id GROUP BY w.doc_id
"""


# --- 4 -----------------------------------------------------------------------


@query
def op4_suffix_array_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


# --- 2 -----------------------------------------------------------------------


@query
def op2_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    archived = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return archived.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op2_warc_dictionary"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages
), m AS (
  SELECT h, max(page_id) AS last FROM p GROUP BY h
), b AS (
  SELECT p.*, m.last, list_transform(range(0, 8), lambda g: ('0x' || substr(p.h, g * 5 + 1, 5))::BIGINT) AS v
  FROM p JOIN m ON p.h = m.h
)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((x >> s) & 31) + 1)::INTEGER, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM b
"""


# --- 3 -----------------------------------------------------------------------


@query
def op3_html_min_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


# --- 5 -----------------------------------------------------------------------


@query
def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = labelled.held_out(F.col("doc_id"), 7, 2)
    model = kneser_ney.train(docs.where(~held_out))
    scored = kneser_ney.score(docs, model)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        kneser_ney.perplexity(F.col("score"), F.col("n_tokens")).alias("perplexity"),
    )


# --- 6 -----------------------------------------------------------------------


@query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES["op6_benchmark_decontamination"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}') AS ws FROM benchmark
), k AS (
  SELECT item_id, ws, least(len(ws), 10) AS k FROM b WHERE len(ws) > 0
), iw AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM k)
), dw AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT doc_id, ws, s.k, unnest(range(1, len(ws) - s.k + 2)) AS i FROM d, (SELECT DISTINCT k FROM k) s WHERE len(ws) >= s.k)
), h AS (
  SELECT doc_id, i, dw.k, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.w = iw.w
), p AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM h) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""


# --- 8 -----------------------------------------------------------------------


@query
def op8_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.occurrences(substring_dedup.passages(table(spark, sf_dir, "documents")))


# --- 9 -----------------------------------------------------------------------


@query
def op9_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixing.choose(table(spark, sf_dir, "documents"))
    return chosen.select("doc_id", "domain", "lang", "source", "n_tokens", "epochs")


def _level_sql(name: str, keys: list[str], weights: dict[str, int], above: str) -> str:
    """Shares of one level of the tree; `above` has the parents' budgets."""
    key, parents = keys[-1], keys[:-1]
    named = "".join(f" WHEN '{k}' THEN {w}" for k, w in weights.items())
    weight = f"CASE {key}{named} ELSE 1 END" if named else "1"
    family = f"PARTITION BY {', '.join(parents)}"
    order = f"{family} ORDER BY supply::DOUBLE / weight::DOUBLE, {key}"
    return f"""{name}_n AS (
  SELECT {', '.join(keys)}, sum(supply) AS supply, ({weight})::HUGEINT AS weight FROM leaf GROUP BY {', '.join(keys)}
), {name}_f AS (
  SELECT *, supply * sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= (budget - coalesce(sum(supply) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS is_full
  FROM {name}_n JOIN {above} USING ({', '.join(parents)})
), {name} AS (
  SELECT {', '.join(keys)}, CASE WHEN is_full THEN supply ELSE
    (budget - coalesce(sum(CASE WHEN is_full THEN supply END) OVER ({family}), 0)) * weight
    // sum(CASE WHEN NOT is_full THEN weight END) OVER ({family}) END AS budget
  FROM {name}_f
)"""


def _mixing_sql(mix: mixing.Mix) -> str:
    names = ["root", "domain", "lang0", "source0"]
    domains = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(mixing.DOMAINS))
    tree = ",\n".join(
        _level_sql(f"l{i}", names[: i + 1], weights, f"l{i - 1}")
        for i, weights in enumerate((mix.domains, mix.languages, mix.sources), 1)
    )
    return rf"""
WITH t AS (
  SELECT doc_id, lang, source, coalesce(lang, chr(1)) AS lang0, coalesce(source, chr(1)) AS source0, 0 AS root,
    CASE coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INTEGER), 0) % {len(mixing.DOMAINS)} {domains} END AS domain,
    len(regexp_extract_all(text, '{_WORD}')) AS n
  FROM documents WHERE len(regexp_extract_all(text, '{_WORD}')) > 0
), leaf AS (
  SELECT root, domain, lang0, source0, sum(n) AS tokens, sum(n) * {mix.max_epochs} AS supply FROM t GROUP BY ALL
), l0 AS (
  SELECT 0 AS root, sum(tokens) * {mix.share[0]} // {mix.share[1]} AS budget FROM leaf
), {tree},
plan AS (
  SELECT domain, lang0, source0, (budget // tokens)::BIGINT AS whole, (budget % tokens)::BIGINT AS rest
  FROM l3 JOIN leaf USING (root, domain, lang0, source0)
), o AS (
  SELECT t.*, whole, rest, ('0x' || substr(md5('{mix.seed}:' || whole || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS point
  FROM t JOIN plan USING (domain, lang0, source0)
), s AS (
  SELECT *, sum(n) OVER (PARTITION BY domain, lang0, source0 ORDER BY point RANGE UNBOUNDED PRECEDING) AS upto FROM o
)
SELECT doc_id, domain, lang, source, n AS n_tokens, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS epochs
FROM s WHERE whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END > 0
"""


ORACLES["op9_hierarchical_mixing"] = _mixing_sql(mixing.DEFAULT)


# --- 7 and 10 ------------------------------------------------------------------


def _classified(scored: DataFrame, cut: float) -> DataFrame:
    return scored.select(
        "doc_id",
        labelled.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


@query
def op7_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = compression_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return _classified(compression_classifier.classify(docs, model), 0.3)


@query
def op10_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _classified(toxicity.classify(docs, model), 0.5)


# --- 11 ------------------------------------------------------------------------


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


_WHITE = r"\x20\x09-\x0D"
_STEP = "CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"

# The oracle walks rows forwards and keeps the least (cost, edits) per role spoken last: 0 nobody, 1 system, 2 user, 3 assistant.
ORACLES["op11_conversation_repair"] = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda x, i: {_STEP}, n::BIGINT)) AS t
), raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
), drawn AS (
  SELECT raw.*, xor(list_reduce(list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT),
      lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 20 AS draw
  FROM raw, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn WHERE draw <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM damaged
), fault AS (
  SELECT *, left(role, 1) AS c, CASE WHEN NOT regexp_matches(text, '[^{_WHITE}]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][{_WHITE}]*\z') THEN 'truncated' ELSE '' END AS f FROM numbered
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum((f = 'blank')::INT) AS blank,
    sum((f = 'duplicate')::INT) AS duplicate, sum((f = 'truncated')::INT) AS truncated,
    sum((before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au'))::INT) AS illegal
  FROM (SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM fault) GROUP BY conv_id
), chain AS (
  SELECT coalesce(conv_id, -1) AS k, conv_id IS NULL AS none, list(struct_pack(c := c, gone := f IN ('blank', 'duplicate'), extra := CASE WHEN f = 'truncated' THEN 3 ELSE 0 END,
      role := role, text := text) ORDER BY n) AS rs
  FROM fault GROUP BY conv_id
), best AS (
  SELECT k, none, 0 AS i, 0 AS st, 0 AS cost, '' AS audit, ''::VARCHAR AS said FROM chain
  UNION ALL
  SELECT k, none, i, st, p.cost, p.audit, p.said FROM (
    SELECT k, none, i, st, min(struct_pack(cost := cost, audit := audit, said := said)) AS p FROM (
      SELECT k, none, i + 1 AS i, cost + 3 * ins + move_cost AS cost, audit || repeat('I', ins) || move AS audit, to_st AS st,
        said || CASE WHEN ins = 0 THEN '' WHEN mid = 2 AND ins = 1 OR mid = 3 AND ins = 3 THEN 'user:' || chr(10)
          WHEN mid = 3 AND ins = 1 THEN 'assistant:' || chr(10) WHEN mid = 3 THEN 'user:' || chr(10) || 'assistant:' || chr(10)
          ELSE 'assistant:' || chr(10) || 'user:' || chr(10) END || line AS said
      FROM (
        SELECT m.*, unnest([
          struct_pack(move := 'D', move_cost := 4, to_st := mid, line := ''),
          struct_pack(move := 'K', move_cost := CASE WHEN NOT r.gone AND (r.c = 's' AND mid = 0 OR r.c = 'u' AND mid <> 2 OR r.c = 'a' AND mid = 2)
              THEN r.extra END, to_st := CASE r.c WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, line := r.role || ':' || r.text || chr(10)),
          struct_pack(move := 'R', move_cost := CASE WHEN NOT r.gone THEN 3 + r.extra END, to_st := CASE WHEN mid = 2 THEN 3 ELSE 2 END,
              line := CASE WHEN mid = 2 THEN 'assistant:' ELSE 'user:' END || r.text || chr(10))], recursive := true)
        FROM (
          SELECT b.*, rs[b.i + 1] AS r, ins, CASE WHEN ins = 0 THEN st WHEN st = 2 THEN CASE WHEN ins % 2 = 1 THEN 3 ELSE 2 END
            ELSE CASE WHEN ins % 2 = 1 THEN 2 ELSE 3 END END AS mid
          FROM best b JOIN chain USING (k, none), unnest([0, 1, 2]) u(ins) WHERE b.i < len(rs)) m)
      WHERE move_cost IS NOT NULL)
    GROUP BY k, none, i, st)
), ended AS (
  SELECT k, none, min(struct_pack(cost := cost + CASE st WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END,
    audit := audit || CASE st WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    said := said || CASE st WHEN 1 THEN 'user:' || chr(10) || 'assistant:' || chr(10) WHEN 2 THEN 'assistant:' || chr(10) ELSE '' END)) AS p
  FROM best JOIN chain USING (k, none) WHERE i = len(rs) GROUP BY k, none
)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(p.cost, 0)::BIGINT AS cost,
  coalesce(p.audit, '') AS audit, sha256(coalesce(left(p.said, length(p.said) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN ended ON ended.k = coalesce(a.conv_id, -1) AND ended.none = (a.conv_id IS NULL)
"""


# --- 12 ------------------------------------------------------------------------


@query
def op12_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path  # vocabularies are installed on the workers, not part of the library

    read = token_records.round_trip(spark, table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


# --- 13 ------------------------------------------------------------------------


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


_LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_PART = "(p - q) * (p - q) // q"

ORACLES["op13_source_divergence"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_LETTERS}') AS ts FROM documents
), o AS (
  SELECT r, lang, source, unnest(ts) AS item FROM d
), k AS (
  SELECT lang, item, count(*) AS n FROM o GROUP BY lang, item HAVING count(DISTINCT r) >= {source_divergence.LEAST}
), l AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, item, count(*) AS n FROM o JOIN k USING (lang, item) GROUP BY lang, source, item
), gn AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source
), s AS (
  SELECT gn.lang, gn.source, k.item, coalesce(c.n, 0) AS n,
    1 + {source_divergence.SCALE}::HUGEINT * (coalesce(c.n, 0) + 1) // (gn.n + l.v) AS p,
    1 + {source_divergence.SCALE}::HUGEINT * (k.n + 1) // (l.n + l.v) AS q
  FROM gn JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.item = k.item
), f AS (
  SELECT lang, source, item, sum({_PART}) AS value
  FROM (SELECT a.lang, a.source, b.source AS item, a.p, b.p AS q FROM s a JOIN s b ON a.lang = b.lang AND a.item = b.item AND a.source <> b.source)
  GROUP BY lang, source, item
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', item, ({_PART})::BIGINT FROM s WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, (row_number() OVER w)::INTEGER AS rank FROM r
WINDOW w AS (PARTITION BY lang, source, part ORDER BY value DESC, item)
QUALIFY part = 'pair' OR row_number() OVER w <= {source_divergence.TOP}
"""
