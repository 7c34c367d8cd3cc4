"""One query per operator on the given tables, with production settings, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loomstar.llm import collocations, decontaminate, exact_dedup, langid, line_dedup, lm_score, main_text, near_dup, packing, periodic, quality, secret_scan, toxicity
from loomstar.llm.tables import held_out
from loomstar.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    """Register ``fn(read) -> DataFrame``, where ``read`` gives a table by name."""

    def add(fn: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


#: A-Z as a-z, in DuckDB.
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _joined(parts: Column) -> Column:
    return F.array_join(parts, ",")


@_query("op1_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT doc_id, body, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
""")
def op1(read):
    found = exact_dedup.exact_dedup(read("documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@_query("op2_language_id")
def op2(read):
    docs = read("documents")
    named = docs.select("doc_id", langid.predict(docs, langid.learn(docs), docs["text"]).alias("p"))
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.accepted").alias("accepted"))


@_query("op3_lm_score")
def op3(read):
    target = read("labels").where("quality = 1").select("doc_id")
    found = lm_score.cross_entropy_difference(read("documents"), target)
    return found.withColumnRenamed("id", "doc_id")


@_query("op4_quality")
def op4(read):
    docs = read("documents")
    scored = docs.select("doc_id", quality.score(docs, quality.learn(docs, read("labels")), docs["text"]).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@_query("op5_toxicity")
def op5(read):
    docs = read("documents")
    scored = docs.select("doc_id", toxicity.score(docs, toxicity.learn(docs, read("labels")), docs["text"]).alias("t"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("t.score").alias("score"), (F.col("t.score") >= 0.3).cast("int").alias("predicted"), F.size("t.hits").alias("n_hits"))


@_query("op6_near_dup", rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, ws[i:i + 3] AS sh FROM d, unnest(range(1, greatest(len(ws) - 4, 0) + 2)) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, l.y FROM reach r JOIN link l ON r.other = l.x)
SELECT r.doc_id, any_value(coalesce(n.n, 0)) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM reach r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id
""")
def op6(read):
    return near_dup.near_dup(read("documents"), size=4).withColumnRenamed("id", "doc_id")


@_query("op7_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
total AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
bad AS (
  SELECT source, line FROM (SELECT DISTINCT doc_id, source, trim(line) AS line FROM lines WHERE trim(line) <> '') JOIN total USING (source)
  GROUP BY source, line, pages HAVING count(*) >= {line_dedup.PAGES} AND count(*) > {line_dedup.RATIO} * pages),
marked AS (SELECT l.doc_id, l.line, l.pos, b.line IS NOT NULL AS dropped FROM lines l LEFT JOIN bad b ON l.source = b.source AND trim(l.line) = b.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op7(read):
    docs = read("documents")
    found = line_dedup.drop_boilerplate(docs, docs["source"])
    return found.select("doc_id", F.col("_lines").cast("long").alias("n_lines"), F.col("_dropped").cast("long").alias("n_dropped"), F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"))


@_query("op8_secret_scan")
def op8(read):
    docs = read("documents")
    found = docs.select("doc_id", secret_scan.find_secrets(docs, docs["text"]).alias("s"))

    def told(spans: Column) -> Column:
        return _joined(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))

    base = F.filter("s", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("s")).alias("spans"))


def pieces(docs: DataFrame) -> DataFrame:
    """Packed pieces of ``docs`` under the public word-level tokenizer, each document closed by id 2."""
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return packed.select(F.col("id").alias("doc_id"), "start", F.col("size").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@_query("op9_packing")
def op9(read):
    return pieces(read("documents"))


@_query("op10_decontaminate", rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS k, ws[i:i + least(10, len(ws)) - 1] AS win FROM b, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS t(i) WHERE len(ws) > 0),
dw AS (SELECT doc_id, i, k, ws[i:i + k - 1] AS win FROM d, (SELECT DISTINCT k FROM bw), unnest(range(1, len(ws) - k + 2)) AS t(i)),
hits AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (k, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN item ON d.doc_id = item.doc_id
""")
def op10(read):
    found = decontaminate.benchmark_hits(read("documents").select("doc_id", "text"), read("benchmark"), into="h")
    return found.select("doc_id", F.col("h.n_words").alias("n_words"), F.col("h.n_hit").alias("n_hit"), F.size("h.items").cast("long").alias("n_items"), F.sha2(_joined(F.array_sort("h.items")).cast("binary"), 256).alias("items_sha256"), (F.col("h.n_hit") > 0).alias("contaminated"))


@_query("op11_collocations", rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOW}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM w, range(1, 6) AS s(k), unnest(range(1, len(ws) - k + 2)) AS t(i)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
total AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM w GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1),
alone AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c d WHERE d.lang = c.lang AND d.k > c.k AND d.f >= c.f AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))),
cut AS (SELECT *, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS head, array_to_string(string_split(phrase, ' ')[j + 1:], ' ') AS rest FROM alone, unnest(range(1, k)) AS t(j)),
scored AS (
  SELECT cut.lang, cut.phrase, j, cut.f AS a, x.f AS l, y.f AS r, n, 1000::HUGEINT * cut.f * n // (x.f::HUGEINT * y.f) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = head JOIN f y ON y.lang = cut.lang AND y.phrase = rest JOIN total ON total.lang = cut.lang),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
""")
def op11(read):
    found = collocations.best(collocations.collocations(read("documents")))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one id in ten by its checksum repeats its words from a place on with a period (fixed by the contract of op12)."""
    mark = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    told = docs.select("doc_id", "text", mark.alias("h"), F.when(mark % 10 == 0, words).alias("w"))
    n, g = F.size("w").cast("long"), F.expr("h div 10")
    period = 1 + F.expr("(n - a) div (3 + g % 8)")
    rest = F.transform(F.sequence(F.col("a"), F.col("n") - 1), lambda i: F.get(F.col("w"), (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    changed = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), rest), " ")
    return told.select("doc_id", "text", "w", n.alias("n"), g.alias("g")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", period).select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


@_query("op12_periodic_runs")
def op12(read):
    docs = planted(read("documents"))
    found = docs.select("doc_id", periodic.periodic_runs(docs, docs["text"]).alias("r")).select("doc_id", "r.runs", "r.collapsed")

    def before(a: Column, b: Column) -> Column:
        """Greater length / period first (as whole numbers), then the earlier start, then the smaller period."""
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        later = F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"]))
        return F.when(x != y, F.signum(y - x)).otherwise(later).cast("int")

    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda top, r: F.when(before(r, top) < 0, r).otherwise(top))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    top = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return top.select("doc_id", "n_runs", "b.start", "b.length", "b.period", F.expr("1000 * b.length div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@_query("op13_main_text")
def op13(read):
    pages = read("pages")
    found = pages.select("page_id", "url", main_text.extract(pages, pages["html"]).alias("t"))
    return found.select("page_id", "url", "t.text", F.length("t.text").cast("long").alias("n_chars"), "t.n_blocks", "t.n_kept")


QUERIES["pipeline"] = corpus_pipeline.run
