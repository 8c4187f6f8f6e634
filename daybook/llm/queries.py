"""One registered query per operator, each over its whole table, and SQL where SQL can say it.

The queries derive what their contract asks for from the operators' results.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    bin_slack,
    compression_quality,
    exact_dedup,
    host_rules,
    merkle,
    mixing,
    packing,
    periodic_runs,
    sharding,
    simhash,
    substrings,
    toxicity,
    url_lists,
)
from daybook.llm.common import utf8
from daybook.sources.scratch import scratch_folder

#: Files of the public vocabulary that the packing query reads.
VOCABULARY = "byte_bpe_50k"
#: The one that the query of minimum bin slack reads.
WORD_VOCABULARY = "word_bpe_49k"

N_SHARDS = 24
OLD_SHARDS = 16


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From shards by source, of very unequal sizes, to 24 of nearly equal bytes."""
    by_source = F.pmod(F.xxhash64("source"), F.lit(OLD_SHARDS)).cast("int")
    docs = _documents(spark, sf_dir).withColumn("old_shard", by_source)
    placed, _ = sharding.reshard(docs, "old_shard", N_SHARDS)
    path = f"{scratch_folder(spark)}/shards"
    sharding.rewrite_shards(placed, path)
    written = spark.read.schema(placed.schema).parquet(path)
    return written.select(
        "doc_id",
        (F.octet_length(utf8(F.col("text"))) + 8).cast("long").alias("size"),
        F.crc32(utf8(F.col("text"))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


CRAWL_START = "2023-01-01"
CRAWL_DAYS = 730


def _digit(text: Column, i: int) -> Column:
    """The i-th hex digit of the text's md5, as a number."""
    return F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(text), i, 1)) - 1


def _dated_entries(hosts: DataFrame) -> DataFrame:
    """Dated list entries of the hosts that occur: some added, some removed, some added again.

    Every domain of two labels is on a list of its own for a month.
    """
    day = _digit(F.col("host"), 1) * 16 + _digit(F.col("host"), 2)
    kind = _digit(F.col("host"), 3)
    start = F.lit(CRAWL_START).cast("date")

    def entry(name: str, rule: str, action: str, days: Column) -> Column:
        at = F.date_add(start, days.cast("int"))
        return F.struct(
            F.lit(name).alias("list"), F.col(rule).alias("rule"), F.lit(action).alias("action"), at.alias("at")
        )

    by_host = F.array(
        entry("hosts", "host", url_lists.ADD, day),
        entry("hosts", "host", url_lists.REMOVE, day + 90 + kind),
        entry("hosts", "host", url_lists.ADD, day + 300),
        entry("spam", "host", url_lists.ADD, day * 2),
    )
    taken = F.when(kind < 4, F.slice(by_host, 1, 3)).when(kind < 6, F.slice(by_host, 4, 1))
    of_hosts = hosts.select(F.explode(taken).alias("e")).select("e.*")
    domains = hosts.select(F.substring_index("host", ".", -2).alias("host")).distinct()
    by_domain = F.array(
        entry("domains", "host", url_lists.ADD, day * 2), entry("domains", "host", url_lists.REMOVE, day * 2 + 30)
    )
    return of_hosts.unionAll(domains.select(F.explode(by_domain).alias("e")).select("e.*"))


def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against lists dated over the two years in which they were fetched."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    fetched = F.date_add(F.lit(CRAWL_START).cast("date"), (F.col("page_id") % CRAWL_DAYS).cast("int"))
    hosts = pages.select(url_lists.host_of(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    return url_lists.judge_captures(pages.withColumn("fetched_at", fetched), _dated_entries(hosts))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir))
    taken = (F.col("size") * F.col("repetitions")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op4_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge_toxicity(_documents(spark, sf_dir), _labels(spark, sf_dir))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(f"{VOCABULARY}.{kind}") for kind in ("json", "tiktoken")]
    return packing.pack_documents(_documents(spark, sf_dir), *paths)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.judge_quality(_documents(spark, sf_dir), _labels(spark, sf_dir))


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge_by_host(_documents(spark, sf_dir))
    return judged.drop("host_rate")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir))


def op11_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(f"{WORD_VOCABULARY}.json")
    return bin_slack.pack_documents(_documents(spark, sf_dir), path)


def _crc(doc_id: Column) -> Column:
    """The unsigned crc32 of the decimal id."""
    return F.crc32(doc_id.cast("string"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """In a tenth of the documents the words from some place on repeat the first few of them."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g = F.floor(_crc(F.col("doc_id")) / 10)
    n = F.size(words)
    a = (g % n).cast("int")
    rest = n - a
    period = (1 + F.floor(rest / (3 + g % 8))).cast("int")
    block = F.slice(words, a + 1, period)
    repeated = F.flatten(F.array_repeat(block, F.ceil(rest / period).cast("int")))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(repeated, F.lit(1), rest)), " ")
    chosen = (_crc(F.col("doc_id")) % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.select("doc_id", F.when(chosen, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(_with_planted_runs(_documents(spark, sf_dir)))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


TAMPERED = 7


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all rows; of every seventh its number of characters was changed before it is held against them."""
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).alias("n_chars")
    changed = merkle.row_digest(*[more if f == "n_chars" else F.col(f) for f in merkle.FIELDS])
    presented = F.when(_crc(F.col("doc_id")) % TAMPERED == 0, changed)
    proved = merkle.merkle_manifest(_documents(spark, sf_dir), presented=presented)
    beside = F.filter("proof", lambda p: p["digest"].isNotNull())
    digests = F.array_join(F.transform(beside, lambda p: F.lower(F.hex(p["digest"]))), "")
    return proved.withColumn("proof", F.sha2(digests, 256)).withColumnRenamed("proof", "proof_sha256")


OP2_SQL = r"""
WITH captures AS (
  SELECT page_id, url, CAST(DATE '2023-01-01' + CAST(page_id % 730 AS INTEGER) AS DATE) AS fetched_at,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '') AS host
  FROM pages),
hosts AS (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL),
named AS (
  SELECT host, list_reduce(string_split(host, '.')[-2:], lambda a, b: a || '.' || b) AS domain FROM hosts),
numbered AS (
  SELECT name, kind_of,
         (instr('0123456789abcdef', md5(name)[1]) - 1) * 16 + instr('0123456789abcdef', md5(name)[2]) - 1 AS day,
         instr('0123456789abcdef', md5(name)[3]) - 1 AS kind
  FROM (SELECT host AS name, 'host' AS kind_of FROM named
        UNION ALL SELECT DISTINCT domain, 'domain' FROM named) AS names),
entries AS (
  SELECT 'hosts' AS list, name AS rule, unnest(['add', 'remove', 'add']) AS action,
         unnest([day, day + 90 + kind, day + 300]) AS days
  FROM numbered WHERE kind_of = 'host' AND kind < 4
  UNION ALL SELECT 'spam', name, 'add', day * 2 FROM numbered WHERE kind_of = 'host' AND kind IN (4, 5)
  UNION ALL SELECT 'domains', name, unnest(['add', 'remove']), unnest([day * 2, day * 2 + 30])
  FROM numbered WHERE kind_of = 'domain'),
dated AS (
  SELECT list, rule, action, DATE '2023-01-01' + CAST(days AS INTEGER) AS since,
         lead(DATE '2023-01-01' + CAST(days AS INTEGER)) OVER (PARTITION BY list, rule ORDER BY days) AS until
  FROM entries),
found AS (
  SELECT page_id, count(*) AS n_active, string_agg(DISTINCT list, ',' ORDER BY list) AS lists
  FROM captures JOIN dated
    ON (host = rule OR (ends_with(host, '.' || rule) AND contains(rule, '.')))
   AND action = 'add' AND since <= fetched_at AND (until IS NULL OR fetched_at < until)
  GROUP BY page_id)
SELECT page_id, url, fetched_at, host, coalesce(n_active, 0) AS n_active, coalesce(lists, '') AS lists,
       n_active IS NOT NULL AS listed
FROM captures LEFT JOIN found USING (page_id)
"""

OP9_SQL = r"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
positions AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM split),
windows AS (
  SELECT doc_id, i, a, lead(a, 1) OVER p AS b, lead(a, 2) OVER p AS c
  FROM positions WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
found AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times FROM windows WHERE c IS NOT NULL),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM found WHERE times > 1) AS f GROUP BY doc_id),
measured AS (
  SELECT doc_id, source, len(w) AS n_words,
         CAST(length(t) - length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words
           OR n_symbols > 0.1 * n_words OR n_dup_lines > 0.1 * n_words AS failed
  FROM measured),
hosts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(failed AS INT)) AS DOUBLE) AS bad
  FROM judged WHERE source IS NOT NULL GROUP BY source),
totals AS (
  SELECT sum(n) AS n, sum(bad) / sum(n) AS mean, sum(bad * bad / n) / sum(n) AS second,
         count(*) AS hosts, sum(n * n) AS squares FROM hosts),
spread AS (
  SELECT mean, (second - mean * mean - mean * (1 - mean) * (hosts - 1) / n)
               / greatest(1e-12, 1 - squares / (n * n)) AS between_ FROM totals),
prior AS (
  SELECT mean, CASE WHEN between_ > 0
                    THEN least(1000, greatest(2, mean * (1 - mean) / between_ - 1)) ELSE 1000 END AS strength
  FROM spread),
rates AS (
  SELECT source, (bad + mean * strength) / (n + strength) AS rate FROM hosts CROSS JOIN prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (rate IS NULL OR rate < 0.5) AS kept
FROM judged LEFT JOIN rates USING (source)
"""

OP10_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""

# The unsigned crc32 of the decimal id, bit by bit.
_CRC_SQL = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT),
                 list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(
      [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, bit: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)))))"""

OP12_SQL = rf"""
WITH given AS (
  SELECT row_number() OVER () AS rid, doc_id, {_CRC_SQL} AS h,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sized AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM given),
planted AS (
  SELECT rid, doc_id, n,
         CASE WHEN h % 10 = 0 AND n > 0
              THEN list_transform(range(n), lambda i:
                     w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1])
              ELSE w END AS w
  FROM sized),
words AS (SELECT rid, n, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS i FROM planted),
grams AS (
  SELECT rid, n, i, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS gram
  FROM words WINDOW o AS (PARTITION BY rid ORDER BY i)),
equal AS (
  SELECT x.rid, x.i, y.i - x.i AS d
  FROM grams x JOIN grams y ON x.rid = y.rid AND x.gram = y.gram AND x.i < y.i AND 4 * (y.i - x.i) <= x.n
  WHERE y.i <= y.n - 5),
numbered AS (SELECT *, i - row_number() OVER (PARTITION BY rid, d ORDER BY i) AS stretch FROM equal),
spans AS (
  SELECT rid, d, min(i) AS start, count(*) + 4 + d AS length FROM numbered GROUP BY rid, d, stretch),
runs AS (
  SELECT rid, start, length, min(d) AS period FROM spans WHERE length >= greatest(6, 4 * d)
  GROUP BY rid, start, length),
best AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY length / period DESC, start, period) AS nth FROM runs),
listed AS (
  SELECT rid, count(*) AS n_runs,
         sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256
  FROM runs GROUP BY rid),
dropped AS (
  SELECT DISTINCT words.rid, i FROM words JOIN runs
    ON words.rid = runs.rid AND i >= start + period AND i < start + length),
left_over AS (
  SELECT rid, sha256(string_agg(w, ' ' ORDER BY i)) AS collapsed_sha256
  FROM words ANTI JOIN dropped USING (rid, i) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
FROM planted LEFT JOIN listed USING (rid) LEFT JOIN left_over USING (rid)
LEFT JOIN (SELECT * FROM best WHERE nth = 1) AS b USING (rid)
"""


def _fields_sql(n_chars: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


OP13_SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, {_fields_sql("n_chars")} AS leaf,
         CASE WHEN {_CRC_SQL} % 7 = 0 THEN {_fields_sql("(CAST(n_chars AS HUGEINT) + 1)")}
              ELSE {_fields_sql("n_chars")} END AS presented
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
tree AS (
  SELECT 0 AS level, lang, i, n, leaf AS d FROM leaves
  UNION ALL
  SELECT level + 1, lang, i // 2, any_value((n + 1) // 2), sha256(string_agg(d, '' ORDER BY i))
  FROM tree WHERE n > 1 GROUP BY level, lang, i // 2),
subroots AS (
  SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, i, n, subroot AS d FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(d, '' ORDER BY i))
  FROM top WHERE n > 1 GROUP BY level, i // 2),
climb AS (
  SELECT rid, 0 AS level, lang, i, n, presented AS now, '' AS proof FROM leaves
  UNION ALL
  SELECT rid, c.level + 1, c.lang, c.i // 2, (c.n + 1) // 2,
         sha256(CASE WHEN d IS NULL THEN now WHEN c.i % 2 = 1 THEN d || now ELSE now || d END),
         proof || coalesce(d, '')
  FROM climb c LEFT JOIN tree t
    ON t.level = c.level AND t.lang IS NOT DISTINCT FROM c.lang AND t.i = xor(c.i, 1)
  WHERE c.n > 1),
climb_top AS (
  SELECT rid, 0 AS level, s.i, s.n, now, proof, subroot
  FROM climb c JOIN subroots s ON c.lang IS NOT DISTINCT FROM s.lang WHERE c.n = 1
  UNION ALL
  SELECT rid, c.level + 1, c.i // 2, (c.n + 1) // 2,
         sha256(CASE WHEN d IS NULL THEN now WHEN c.i % 2 = 1 THEN d || now ELSE now || d END),
         proof || coalesce(d, ''), subroot
  FROM climb_top c LEFT JOIN top t ON t.level = c.level AND t.i = xor(c.i, 1)
  WHERE c.n > 1)
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = d AS verified
FROM hashed JOIN climb_top USING (rid) JOIN top ON top.n = 1
WHERE climb_top.n = 1
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_reshard": op1_reshard,
    "op2_url_lists": op2_url_lists,
    "op3_mix": op3_mix,
    "op4_remove_repeats": op4_remove_repeats,
    "op5_simhash": op5_simhash,
    "op6_toxicity": op6_toxicity,
    "op7_pack": op7_pack,
    "op8_quality": op8_quality,
    "op9_host_rules": op9_host_rules,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_bin_slack": op11_bin_slack,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle": op13_merkle,
}

ORACLE_SQL: dict[str, str] = {
    "op2_url_lists": OP2_SQL,
    "op9_host_rules": OP9_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op12_periodic_runs": OP12_SQL,
    "op13_merkle": OP13_SQL,
}
