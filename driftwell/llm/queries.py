"""The registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, fim, licenses, neardup, packing, periodic, pii, secrets, simhash, topk, toxicity, urls


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_files() -> dict:
    """Parameters of the packing operator: where the public vocabulary files are."""
    import public_tokenizers as public

    return {"tokenizer": public.path("byte_bpe_50k.json"), "ranks": public.path("byte_bpe_50k.tiktoken"), "pattern": public.PATTERN}


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(_read(spark, sf_dir, "documents"))


def demo_entries(pages: DataFrame) -> DataFrame:
    """A dated filter list over the hosts at hand: which hosts, and when, follows from digests of their names."""
    digit = lambda at: F.instr(F.lit("0123456789abcdef"), F.substring("h", at, 1)) - 1
    hosts = pages.select(urls.host(F.col("url")).alias("host")).where("host != ''").distinct().withColumn("h", F.md5("host"))
    start = F.date_add(F.lit("2024-01-01").cast("date"), (digit(2) * 10).cast("int"))
    row = lambda key, category, dated, action: F.struct(key.alias("key"), F.lit(category).alias("category"), dated.alias("dated"), F.lit(action).alias("action"))
    plain, other = digit(1) < 4, digit(1) >= 12
    parent = F.substring_index("host", ".", -3)
    return hosts.select(
        F.explode(
            F.filter(
                F.array(
                    F.when(plain, row(F.col("host"), "blocked", start, "add")),
                    F.when(plain & (digit(3) < 8), row(F.col("host"), "blocked", F.date_add(start, 100), "remove")),
                    F.when(plain & (digit(3) < 4), row(F.col("host"), "blocked", F.date_add(start, 200), "add")),
                    F.when(other, row(F.concat("host", F.lit("/en")), "section", start, "add")),
                    F.when(digit(4) == 0, row(parent, "parent", F.date_add(start, 30), "add")),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("e")
    ).select("e.*")


def op2_url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(360)).cast("int")).alias("fetched"))
    out = urls.evaluate(captures, demo_entries(pages))
    return out.select("page_id", F.date_format("fetched", "yyyy-MM-dd").alias("fetched"), "listed", "n_active", "categories", "key", F.date_format("since", "yyyy-MM-dd").alias("since"))


OP2_SQL = r"""
WITH p AS (SELECT page_id, url, lower(rtrim(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '.')) AS host,
                  regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)?', 1) AS path,
                  DATE '2024-01-01' + CAST(page_id % 360 AS INTEGER) AS fetched FROM pages),
hosts AS (SELECT host, instr('0123456789abcdef', substr(h, 1, 1)) - 1 AS d1, DATE '2024-01-01' + CAST((instr('0123456789abcdef', substr(h, 2, 1)) - 1) * 10 AS INTEGER) AS start,
                 instr('0123456789abcdef', substr(h, 3, 1)) - 1 AS d3, instr('0123456789abcdef', substr(h, 4, 1)) - 1 AS d4
          FROM (SELECT DISTINCT host, md5(host) AS h FROM p WHERE host <> '')),
entries AS (SELECT host AS key, 'blocked' AS category, start AS dated, 1 AS adds FROM hosts WHERE d1 < 4
            UNION ALL SELECT host, 'blocked', start + 100, 0 FROM hosts WHERE d1 < 4 AND d3 < 8
            UNION ALL SELECT host, 'blocked', start + 200, 1 FROM hosts WHERE d1 < 4 AND d3 < 4
            UNION ALL SELECT host || '/en', 'section', start, 1 FROM hosts WHERE d1 >= 12
            UNION ALL SELECT array_to_string(list_slice(string_split(host, '.'), -3, -1), '.'), 'parent', start + 30, 1 FROM hosts WHERE d4 = 0),
daily AS (SELECT key, category, dated, min(adds) AS adds FROM entries GROUP BY ALL),
steps AS (SELECT *, coalesce(lag(adds) OVER w, 0) AS before FROM daily WINDOW w AS (PARTITION BY key, category ORDER BY dated)),
spans AS (SELECT key, category, adds, dated AS valid_from, lead(dated) OVER (PARTITION BY key, category ORDER BY dated) AS valid_to FROM steps WHERE adds <> before),
captures AS (SELECT page_id, url, fetched, unnest(list_distinct(list_concat(
                 list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
                 list_transform(list_filter([1, 2], lambda k: k <= len(list_filter(string_split(path, '/'), lambda s: s <> ''))), lambda k: host || '/' || array_to_string(list_filter(string_split(path, '/'), lambda s: s <> '')[1:k], '/'))))) AS key FROM p WHERE host <> ''),
hits AS (SELECT c.page_id, c.url, c.fetched, s.key, s.category, s.valid_from FROM captures c JOIN spans s ON c.key = s.key AND s.adds = 1 AND c.fetched >= s.valid_from AND (s.valid_to IS NULL OR c.fetched < s.valid_to)),
found AS (SELECT page_id, url, fetched, count(DISTINCT (key, category)) AS n_active, array_to_string(list_sort(list(DISTINCT category)), ',') AS categories, max({'n': length(key), 'key': key, 'since': valid_from}) AS best FROM hits GROUP BY page_id, url, fetched)
SELECT p.page_id, strftime(p.fetched, '%Y-%m-%d') AS fetched, coalesce(n_active, 0) > 0 AS listed, coalesce(n_active, 0) AS n_active, coalesce(categories, '') AS categories, best.key AS key, strftime(best.since, '%Y-%m-%d') AS since
FROM (SELECT DISTINCT page_id, url, fetched FROM p) p LEFT JOIN found ON p.page_id = found.page_id AND p.url = found.url AND p.fetched = found.fetched
"""


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_read(spark, sf_dir, "documents"), **tokenizer_files())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(_read(spark, sf_dir, "documents"), shingle=3, percent=85)


OP6_EXTRA = "</s>[INST] ok [/INST]"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(OP6_EXTRA).alias("text")) for i, r in enumerate(("user", "assistant"))))).alias("x")).select("x.*")
    records = rows.unionByName(extra).select(F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    return chat.read_back(chat.format_turns(chat.canonical_turns(records)), ordered=True)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.scan(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


OP10_SQL = """
WITH usable AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
                WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
flat AS (SELECT vec_id, r, unnest(range(1, len(q) + 1)) AS d, unnest(q) AS v FROM usable),
products AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.v * b.v) AS BIGINT) AS score FROM flat a JOIN flat b ON a.d = b.d AND a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id GROUP BY a.vec_id, b.vec_id, a.r, b.r),
scores AS (SELECT query_id, vec_id, max(score) AS score FROM products GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 20
"""


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.examples(_read(spark, sf_dir, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(F.col("form"), F.col("output")), 256).alias("restored_sha256")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS head, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS tail FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(head) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || middle ELSE '<S>' || tail || '<P>' || head || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p
"""


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.link(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def periodic_texts(docs: DataFrame) -> DataFrame:
    """One document in ten, by a checksum of its id, has its words from some place on replaced by repeats of the first few of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    drawn = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.size("words").cast("long"))
    g = F.floor(F.col("h") / 10)
    planted = drawn.withColumn("a", F.when(F.col("n") > 0, g % F.col("n"))).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    text = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", place(i).cast("int"))), " ")
    return planted.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(periodic_texts(_read(spark, sf_dir, "documents"))).withColumn("best", periodic.longest())
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    start, length, period = F.col("best.start"), -F.col("best.n"), F.col("best.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {f.__name__: f for f in (op1_pii, op2_url_list, op3_secrets, op4_packing, op5_neardup, op6_chat, op7_decontaminate, op8_toxicity, op9_licenses, op10_topk, op11_fim, op12_simhash, op13_runs)}
SQL = {"op2_url_list": OP2_SQL, "op10_topk": OP10_SQL, "op11_fim": OP11_SQL}
