"""The registered queries of the training-data operators, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import (
    bitslice, decontam, forest, langid, licenses, mixing, passages, ranking, simhash, spelling, turns, urlfilter, warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The same templates with patterns that look nowhere back: sentence starts are marked first. Slots are compared along
# alignments, as in the operator; windows are compared as texts.
OP1_SQL = r"""
WITH given AS (
  SELECT true AS is_doc, doc_id AS id, text FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT false, item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), a AS (
  SELECT is_doc, id, CASE WHEN regexp_matches(text, '[0-9]') THEN
    regexp_replace(regexp_replace(text, '([0-9])[.,]([0-9])', '\1\2', 'g'), '([0-9])([A-Za-z%])', '\1 \2', 'g') ELSE text END AS apart
  FROM given
), p AS (
  SELECT is_doc, id, apart, regexp_replace(regexp_replace(lower(replace(regexp_replace(
      regexp_replace(apart, '(^|[.!?:\n"'' ]) ([A-Z])', '\1 ¬\2', 'g'),
      ' [A-Z][^\x00-\x60\x7B-\x7F]+', ' ⓝ', 'g'), '¬', '')), '[0-9]+', '⓪', 'g'),
    '⓪ (UNITS)([^a-z]|$)', '⓪ ⓤ\2', 'g') AS plain
  FROM a
), w AS (
  SELECT is_doc, id,
    list_filter(regexp_split_to_array(plain, 'SEPARATORS'), lambda x: x <> '') AS tokens,
    list_filter(regexp_split_to_array(lower(apart), 'SEPARATORS'), lambda x: x <> '') AS words
  FROM p
), v AS (
  SELECT is_doc, id, i AS pos, false AS literal, tokens[i:i + 4] AS win, words[i:i + 4] AS own
  FROM w, unnest(range(1, len(tokens) - 3)) AS u(i) WHERE len(tokens) >= 5
), t AS (
  SELECT * FROM v WHERE NOT is_doc AND len(list_filter(win, lambda x: x NOT IN ('⓪', 'ⓝ', 'ⓤ'))) > 0
), l AS (
  SELECT id, words, least(len(words), 5) AS n FROM w WHERE NOT is_doc AND len(words) > 0 AND id NOT IN (SELECT id FROM t)
), items AS (
  SELECT id, pos, literal, win, own FROM t
  UNION ALL SELECT id, i, true, words[i:i + n - 1], words[i:i + n - 1] FROM l, unnest(range(1, len(words) - n + 2)) AS u(i)
), docs AS (
  SELECT id, pos, literal, win, own FROM v WHERE is_doc
  UNION ALL SELECT id, i, true, words[i:i + n - 1], words[i:i + n - 1]
  FROM w, (SELECT DISTINCT n FROM l) AS k, unnest(range(1, len(words) - n + 2)) AS u(i) WHERE is_doc AND len(words) >= n
), m AS (
  SELECT d.id AS doc_id, b.id AS item_id, d.pos - b.pos AS shift, b.literal, b.win, d.own AS theirs, b.own AS ours
  FROM docs d JOIN items b ON d.win = b.win AND d.literal = b.literal
), n AS (
  SELECT id AS item_id, count(DISTINCT win) AS n_item_windows FROM items GROUP BY id
), s AS (
  SELECT DISTINCT doc_id, item_id, shift, win[k] AS kind, ours[k] AS ours, theirs[k] AS theirs
  FROM m, unnest(range(1, 6)) AS u(k) WHERE NOT literal AND regexp_matches(win[k], '[⓪ⓝⓤ]')
), bad AS (
  SELECT DISTINCT doc_id, item_id, shift FROM s WHERE kind = 'ⓝ' GROUP BY doc_id, item_id, shift, ours HAVING count(DISTINCT theirs) > 1
), h AS (
  SELECT m.doc_id, m.item_id, count(DISTINCT m.win) AS n_windows FROM m
  LEFT JOIN bad ON m.doc_id IS NOT DISTINCT FROM bad.doc_id AND m.item_id = bad.item_id AND m.shift = bad.shift
  WHERE bad.item_id IS NULL GROUP BY m.doc_id, m.item_id
), c AS (
  SELECT s.doc_id, s.item_id, count(DISTINCT (s.kind, s.ours)) AS n_slots,
    count(DISTINCT CASE WHEN s.ours <> s.theirs THEN (s.kind, s.ours) END) AS n_changed
  FROM s LEFT JOIN bad ON s.doc_id IS NOT DISTINCT FROM bad.doc_id AND s.item_id = bad.item_id AND s.shift = bad.shift
  WHERE bad.item_id IS NULL GROUP BY s.doc_id, s.item_id
)
SELECT h.doc_id, h.item_id, n_windows, n_item_windows, coalesce(n_slots, 0) AS n_slots, coalesce(n_changed, 0) AS n_changed
FROM h JOIN n ON h.item_id = n.item_id
LEFT JOIN c ON h.doc_id IS NOT DISTINCT FROM c.doc_id AND h.item_id = c.item_id
WHERE n_windows >= ceil(0.8 * n_item_windows - 1e-9)
""".replace("UNITS", decontam.UNITS).replace("SEPARATORS", decontam.SEPARATORS)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages
), q AS (
  SELECT *, min(page_id) OVER (PARTITION BY n, h) AS least FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
    (((('0x' || h[(5 * (i // 4) + 1):(5 * (i // 4) + 5)])::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT]), '') AS payload_digest,
  CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> least THEN least END AS refers_to
FROM q
"""


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')), 1, 13))::BIGINT AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w,
    row_number() OVER (ORDER BY source ASC NULLS LAST) AS nth
  FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER (ORDER BY source_size / w, nth) AS place,
    sum(source_size) OVER ()::HUGEINT - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / w, nth
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS left_words,
    sum(w) OVER (ORDER BY source_size / w, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS left_weight
  FROM s
), r AS (
  SELECT place, left_words, left_weight FROM o
  WHERE NOT (3 * source_size * left_weight <= left_words * w) ORDER BY place LIMIT 1
), t AS (
  SELECT o.source, o.source_size,
    CASE WHEN r.place IS NULL OR o.place < r.place THEN (3 * o.source_size)::DOUBLE
      ELSE (o.w * r.left_words)::DOUBLE / r.left_weight::DOUBLE END AS target
  FROM o LEFT JOIN r ON true
), x AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size > 0 THEN (budget // source_size) * size
    + greatest(0, least(size, budget - (budget // source_size) * source_size - ahead)) ELSE 0 END)::BIGINT AS taken
FROM x
"""


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("met")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.classes(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predictions(docs, langid.train(docs))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# The rules of the contract, and the patterns that the method adds.
URL_RULES = (
    urlfilter.Rule("||com/en/", "block"),
    urlfilter.Rule("||example.com/en/7", "allow"),
    urlfilter.Rule("||net/de/", "allow"),
    urlfilter.Rule("||example.net/de/8", "block"),
    urlfilter.Rule("||org/es/", "block"),
)
URL_PATTERNS = tuple(
    urlfilter.Rule(pattern, "block")
    for pattern in (
        "^ads^", "^adserver^", "^adult^", "^affiliate^*^click^", "^analytics^*^collect^", "^banner^", "^banners^*.gif", "^beacon^",
        "^bets^", "^betting^", "^bitcoin^*^doubler^", "^bonus^*^casino^", "^casino^", "^cheap^*^pills^", "^clickbait^", "^crack^*^keygen^",
        "^doubleclick^", "^escort^", "^free^*^viagra^", "^gambling^", "^jackpot^", "^keygen^", "^malware^", "^nsfw^", "^payday^*^loan^",
        "^phishing^", "^pills^", "^pixel^*^track^", "^poker^", "^popunder^", "^porn^", "^redirect^*^http^", "^slots^*^casino^", "^spam^",
        "^sponsored^", "^torrent^*^download^", "^track^*^pixel^", "^viagra^", "^warez^", "^wp-login^", "^xxx^",
    )
)


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES, URL_PATTERNS)


OP9_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), v AS (
  SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), rules(rule_host, rule_path, action) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
    ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), f AS (
  SELECT v.*, rule_host || rule_path AS rule, action,
    row_number() OVER (PARTITION BY page_id ORDER BY len(rule_host || rule_path) DESC NULLS LAST) AS nth
  FROM v LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule,
  coalesce(action, CASE WHEN PATTERNS THEN 'block' ELSE 'allow' END) AS verdict
FROM f WHERE nth = 1
""".replace(
    "PATTERNS",
    " OR ".join(
        "regexp_matches(lower(host || path), '(?s)" + r.pattern.replace(".", "[.]").replace("*", ".*").replace("^", "(^|[^0-9a-z]|$)") + "')"
        for r in URL_PATTERNS
    ),
)


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forest.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), forest.SAMPLE_ROWS)
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(table(spark, sf_dir, "embeddings"))


OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id ASC NULLS LAST) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op13_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repaired(table(spark, sf_dir, "conversations"))


def queries() -> dict:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_warc": op2_warc,
        "op3_mixing": op3_mixing,
        "op4_licenses": op4_licenses,
        "op5_quality": op5_quality,
        "op6_passages": op6_passages,
        "op7_language": op7_language,
        "op8_simhash": op8_simhash,
        "op9_url_rules": op9_url_rules,
        "op10_rules": op10_rules,
        "op11_spelling": op11_spelling,
        "op12_top_k": op12_top_k,
        "op13_turns": op13_turns,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": OP1_SQL, "op2_warc": OP2_SQL, "op3_mixing": OP3_SQL, "op9_url_rules": OP9_SQL, "op12_top_k": OP12_SQL}
