"""One registered query per operator, over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, mixing, near_dedup, shards, url_filter
from .common import WORD, cut, table
from .decontaminate import contaminated
from .hard_negatives import hard_negatives
from .html_extract import html_extract
from .line_quality import line_quality
from .mixing import word_count
from .periodic_runs import periodic_runs
from .personal_data import KINDS, personal_data
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM words WHERE len(w) >= 35),
windows AS (
  SELECT doc_id, p, md5(array_to_string(list_slice(w, p, p + 34), ' ')) AS h FROM starts),
repeats AS (
  SELECT doc_id, p FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1),
gone AS (
  SELECT DISTINCT doc_id, p + unnest(range(0, 35)) AS i FROM repeats),
lists AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id),
word_rows AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT r.doc_id, string_agg(x, ' ' ORDER BY r.i) AS k, count(*) AS n
  FROM word_rows r ANTI JOIN gone g ON r.doc_id = g.doc_id AND r.i = g.i GROUP BY r.doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.k, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""


@query("op1_substring_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT source, source_size, source_size * 3 AS cap,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w FROM sizes),
rest AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS left_size,
    sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS left_w
  FROM ranked WINDOW before AS (
    ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stopped AS (SELECT *, cap * left_w < w * left_size AS stop FROM rest),
targets AS (
  SELECT source, source_size, CASE WHEN stop OR cap = 0 THEN cap::DOUBLE ELSE
    (sum(source_size) OVER () - sum(CASE WHEN stop THEN cap ELSE 0 END) OVER ())::DOUBLE * w
    / (sum(CASE WHEN stop THEN 0 ELSE w END) OVER ())::DOUBLE END AS target FROM stopped),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0 END AS rate,
    ('0x' || substr(md5('mix' || coalesce(':' || d.source, '')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS off,
    row_number() OVER (PARTITION BY d.source ORDER BY length(bin(size)),
      size >> greatest(0, length(bin(size)) - 7), substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 3), size, doc_id) AS place
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * least(3, floor(off + place * rate) - floor(off + (place - 1) * rate)))::BIGINT AS taken
FROM placed
"""


@query("op2_mix_sources", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    narrow = cut(docs.select("doc_id", "source", word_count("text").alias("words")), "op2-sizes")
    out = mixing.copies(narrow, F.col("words"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP8_SQL = f"""
WITH RECURSIVE shards AS (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 2, '0') AS shard FROM range({len(shards.SHARDS)}) t(i)),
prefer AS (
  SELECT list(('0x' || substr(md5('offset:' || shard), 1, 15))::BIGINT % {shards.SIZE} ORDER BY i) AS offs,
    list(('0x' || substr(md5('skip:' || shard), 1, 15))::BIGINT % {shards.SIZE - 1} + 1 ORDER BY i) AS skips FROM shards),
claims AS (
  SELECT 0 AS turn, list_transform(range({shards.SIZE}), lambda x: -1) AS owner FROM prefer
  UNION ALL
  SELECT turn + 1, owner[:slot] || [turn % {len(shards.SHARDS)}] || owner[slot + 2:] FROM (
    SELECT turn, owner, list_filter(
      list_transform(range({shards.SIZE}), lambda j: (offs[turn % {len(shards.SHARDS)} + 1] + j * skips[turn % {len(shards.SHARDS)} + 1]) % {shards.SIZE}),
      lambda s: owner[s + 1] = -1)[1] AS slot
    FROM claims, prefer WHERE turn < {shards.SIZE})),
slots AS (
  SELECT unnest(range({shards.SIZE})) AS slot, unnest(owner) AS i FROM claims WHERE turn = {shards.SIZE}),
docs AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {shards.SIZE} AS slot FROM documents)
SELECT d.doc_id, d.slot, h.shard FROM docs d JOIN slots s ON d.slot = s.slot JOIN shards h ON h.i = s.i
"""


@query("op8_shards", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents").select("doc_id"))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = F.crc32(F.col("doc_id").cast("string")) % 3
    model = language_id.fit(docs.filter(part != 1))
    out = language_id.predict(docs.select("doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "text"), model)
    return out.select("row.doc_id", "row.held_out", "lang_pred", "score", "rejected")


OP6_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM docs WHERE len(w) > 2)),
again AS (SELECT doc_id, p FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeated AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, p + unnest([0, 1, 2]) AS i FROM again) GROUP BY doc_id),
all_lines AS (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS l FROM docs),
lines AS (
  SELECT doc_id, source, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
    regexp_replace(array_to_string(regexp_extract_all(lower(l), '[^\x20\x09-\x0D]+'), ' '), '[1-9]', '0', 'g') AS k
  FROM all_lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dups AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY doc_id),
hosts AS (SELECT source, count(*) AS docs FROM docs GROUP BY source),
above AS (
  SELECT l.source, l.k FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, l.k, h.docs HAVING count(DISTINCT doc_id) > greatest(20, h.docs * 0.02::DOUBLE)),
removed AS (
  SELECT l.doc_id, sum(l.n) AS n FROM lines l JOIN above a ON l.source IS NOT DISTINCT FROM a.source AND l.k = a.k
  GROUP BY l.doc_id),
stats AS (
  SELECT d.doc_id, len(d.w)::BIGINT AS n_words,
    length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(d.t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(u.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    coalesce(x.n, 0)::BIGINT AS n_removed_words
  FROM docs d LEFT JOIN dups u USING (doc_id) LEFT JOIN repeated r USING (doc_id) LEFT JOIN removed x USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  n_words - n_removed_words < 0.3::DOUBLE * n_words AS depleted,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_words - n_removed_words < 0.3::DOUBLE * n_words) AS kept
FROM stats
"""


@query("op6_line_quality", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH pages2 AS (
  SELECT page_id, url, DATE '2024-01-01' + (page_id * 7919 % 365)::INT AS day,
    regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[?#].*$', '') AS c FROM pages),
parts AS (
  SELECT *, lower(regexp_replace(regexp_extract(c, '^([^/]*)', 1), '^.*@|:[0-9]*$', '')) AS host,
    regexp_replace(regexp_extract(c, '^[^/]*(.*)$', 1), '/+$', '') AS path FROM pages2),
keyed AS (
  SELECT page_id, url, day, host, host || path AS canon, string_split(host, '.') AS labels FROM parts),
keys AS (
  SELECT page_id, day, unnest(list_distinct([canon] || list_transform(range(1, greatest(len(labels) - 1, 1) + 1),
    lambda i: array_to_string(labels[i:], '.')))) AS key FROM keyed),
entries AS (
  SELECT CASE WHEN page_id % 5 = 0 THEN 'allow' ELSE 'block' END AS list,
    CASE page_id % 3 WHEN 0 THEN canon WHEN 1 THEN host ELSE array_to_string(labels[greatest(len(labels) - 1, 1):], '.') END AS key,
    CASE WHEN (page_id // 3) % 2 = 0 THEN 'add' ELSE 'remove' END AS action,
    DATE '2024-01-01' + (page_id * 104729 % 365)::INT AS day, page_id AS seq FROM keyed),
last_of_day AS (
  SELECT list, key, day, arg_max(action, seq) AS action FROM entries GROUP BY list, key, day),
steps AS (
  SELECT *, coalesce(lead(day) OVER (PARTITION BY list, key ORDER BY day), DATE '9999-12-31') AS until FROM last_of_day),
active AS (
  SELECT k.page_id, s.list FROM keys k JOIN steps s
  ON k.key = s.key AND s.action = 'add' AND s.day <= k.day AND k.day < s.until),
counts AS (
  SELECT page_id, count(*) FILTER (list = 'block') AS b, count(*) FILTER (list = 'allow') AS a FROM active GROUP BY page_id)
SELECT p.page_id, p.url, strftime(p.day, '%Y-%m-%d') AS day, coalesce(b, 0)::BIGINT AS n_block, coalesce(a, 0)::BIGINT AS n_allow,
  coalesce(b, 0) > 0 AND coalesce(a, 0) = 0 AS blocked
FROM keyed p LEFT JOIN counts c USING (page_id)
"""


@query("op4_url_filter", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages, dated by id; every page also contributes one dated list entry."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    dated = lambda factor: F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * factor % 365).cast("int"))
    host = url_filter.host_of("url")
    labels = F.split(host, r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    entries = pages.select(
        F.when(F.col("page_id") % 5 == 0, "allow").otherwise("block").alias("list"),
        F.when(F.col("page_id") % 3 == 0, url_filter.canonical("url")).when(F.col("page_id") % 3 == 1, host).otherwise(domain).alias("key"),
        F.when(F.floor(F.col("page_id") / 3) % 2 == 0, "add").otherwise("remove").alias("action"),
        dated(104729).alias("day"), F.col("page_id").alias("seq"),
    )
    out = url_filter.evaluate(pages.withColumn("day", dated(7919)), entries)
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


OP3_SQL = r"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
windows AS (
  SELECT doc_id, p, substr(h, 2 * p - 1, 100) AS s FROM (
    SELECT doc_id, h, unnest(range(1, n - 48)) AS p FROM docs WHERE n >= 50)),
repeats AS (SELECT doc_id, p FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY s)),
gone AS (SELECT DISTINCT doc_id, p + unnest(range(0, 50)) AS i FROM repeats),
runs AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before <> i - 1) AS n_spans FROM (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM gone) GROUP BY doc_id),
kept AS (
  SELECT b.doc_id, string_agg(x, '' ORDER BY b.i) AS k FROM (
    SELECT doc_id, p AS i, substr(h, 2 * p - 1, 2) AS x FROM (
      SELECT doc_id, h, unnest(range(1, n + 1)) AS p FROM docs SEMI JOIN runs USING (doc_id))) b
  ANTI JOIN gone g ON b.doc_id = g.doc_id AND b.i = g.i GROUP BY b.doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(r.n_removed, 0)::BIGINT AS n_removed,
  coalesce(r.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.k, CASE WHEN r.doc_id IS NULL THEN d.h ELSE '' END))) AS kept_sha256
FROM docs d LEFT JOIN runs r ON d.doc_id = r.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@query("op3_suffix_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_decontaminate")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents, with the item found in them."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.when(~F.col("null_id"), F.col("doc")).alias("doc_id"), F.col("item").alias("item_id"), "windows", "item_windows", "shift"
    )


@query("op10_html_extract")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op7_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class (the smallest doc_id in it) and the number of documents in the class."""
    out = near_dedup.classes(table(spark, sf_dir, "documents"))
    return out.select(F.when(~F.col("null_id"), F.col("doc")).alias("doc_id"), "class_id", "members")


OP11_SQL = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda c: list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS tab),
base AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w0,
    xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM documents, crc_table),
dealt AS (
  SELECT doc_id, w0, len(w0) AS n, coalesce(h % 10 = 0, false) AND len(w0) > 0 AS planted, h // 10 AS g FROM base),
cuts AS (SELECT *, CASE WHEN planted THEN g % n ELSE n END AS a FROM dealt),
words AS (
  SELECT doc_id, n, CASE WHEN planted THEN
    w0[:a] || list_transform(range(0, n - a), lambda t: w0[a + 1 + t % (1 + (n - a) // (3 + g % 8))]) ELSE w0 END AS w
  FROM cuts),
places AS (SELECT doc_id, n, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM words),
pairs AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM places a JOIN places b
  ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pairs),
long AS (
  SELECT doc_id, q AS period, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, k
  HAVING count(*) + q >= greatest(6, 4 * q)),
found AS (
  SELECT * FROM long r WHERE NOT EXISTS (
    SELECT 1 FROM long s WHERE s.doc_id = r.doc_id AND s.period < r.period
    AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
tops AS (
  SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
lists AS (
  SELECT doc_id, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s FROM found GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM found),
kept AS (
  SELECT p.doc_id, string_agg(x, ' ' ORDER BY p.i) AS k FROM places p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i
  GROUP BY p.doc_id)
SELECT w.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, t.start::BIGINT AS start, t.length::BIGINT AS length,
  t.period::BIGINT AS period, (1000 * t.length // t.period)::BIGINT AS exponent_milli,
  sha256(coalesce(l.s, '')) AS runs_sha256, sha256(coalesce(k.k, '')) AS collapsed_sha256
FROM words w LEFT JOIN lists l ON w.doc_id = l.doc_id LEFT JOIN tops t ON w.doc_id = t.doc_id
LEFT JOIN kept k ON w.doc_id = k.doc_id
"""


def repeated_tails(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where every tenth document by id hash repeats the first words of its tail to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"))
    hit = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w")
    cuts = hit.select("*", n.alias("n"), F.when(n > 0, F.col("g") % n).cast("int").alias("a"))
    tail = F.col("n") - F.col("a")
    period = (F.lit(1) + F.floor(tail / (3 + F.col("g") % 8))).cast("int")
    times = F.ceil(tail / period).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, period), times)), 1, tail)
    changed = F.array_join(F.concat(F.slice("w", 1, F.col("a")), again), " ")
    return cuts.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of documents, some of which first get a periodic tail."""
    out = periodic_runs(repeated_tails(table(spark, sf_dir, "documents")))
    line = lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])
    return out.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


OP13_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM usable a JOIN usable r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
  s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are every hundredth row by id; every seventh row has the next label."""
    scaled = lambda x: 256 * x.cast("double")
    # floor() gives a long; what does not fit one is whole already, or not finite and has to stay so
    whole = lambda x: F.when(F.abs(scaled(x)) < 2.0**53, F.floor(scaled(x)).cast("double")).otherwise(scaled(x))
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", whole).alias("vector"),
    )
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


@query("op12_personal_data")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the strict spans, and all spans with those that the method adds."""
    out = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    strict = F.filter("spans", lambda s: s["strict"])
    of = lambda kind: F.filter(strict, lambda s: s["kind"] == kind)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return out.select("row.doc_id", *counts, F.sha2(listed(strict), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
