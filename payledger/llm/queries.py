"""Driver queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from payledger.llm import (decontaminate, html_extract, language_id, lm_scoring, merkle_manifest, minhash_dedup, mixing,
                           quality_rules, secret_scan, sentencepiece_codec, substring_dedup, token_alignment, url_filters)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(_table(spark, sf_dir, "documents")).drop("th")


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(_table(spark, sf_dir, "pages"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(_table(spark, sf_dir, "documents"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.verify(merkle_manifest.manifest(_table(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_source_mixing, op2_decontamination, op3_substring_dedup, op4_secret_scan, op5_language_id, op6_minhash_dedup,
        op7_quality_rules, op8_url_filters, op9_lm_scoring, op10_html_extract, op11_token_alignment,
        op12_sentencepiece, op13_merkle_manifest, pipeline)}


# DuckDB; the character lists are those of the contracts.
_LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORDS = "regexp_extract_all(" + _LOW + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_BENCH_WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {_BENCH_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM grams),
runs AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hits AS (SELECT r, i, runs.k, item_id FROM runs JOIN grams ON runs.k = grams.k AND runs.g = grams.g),
marked AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN named USING (r)
"""

OP3_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS o,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (SELECT r, o, i, md5_number(array_to_string(w[i:i + 49], ' ')) AS g
  FROM (SELECT r, o, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
late AS (SELECT r, i FROM (SELECT r, i, o, min(o) OVER (PARTITION BY g) AS lo FROM runs) WHERE lo < o),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 50)) AS p FROM late)),
each AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, count(g.q) AS n_removed, string_agg(word, ' ' ORDER BY x.p) FILTER (WHERE g.q IS NULL) AS t
  FROM (SELECT r, word, p FROM each) x LEFT JOIN (SELECT r, p, p AS q FROM gone) g USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


OP6_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, md5_number(array_to_string(w[i:i + k - 1], ' ')) AS g
  FROM (SELECT r, w, least(len(w), 4) AS k, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
links AS (SELECT x, y FROM pairs JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * common >= 80 * (p.n + q.n - common)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(r, t) AS (SELECT r, r FROM d UNION SELECT reach.r, y FROM reach JOIN ways ON t = x),
least_id AS (SELECT reach.r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = t GROUP BY reach.r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN least_id USING (r) LEFT JOIN n USING (r)
"""


def _field_sql(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _merkle_sql(levels: int = 8, top_levels: int = 6) -> str:
    """Trees of up to 16^levels documents a source and 16^top_levels sources. A
    tree of one node stays as it is on all further levels (no step). The CRC-32 is
    taken bit by bit: -1 stands for a shift, other values are taken up."""
    ctes = [f"""e AS (SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
      CASE WHEN xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
          lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
          lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) % 5 = 0
      THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
    FROM documents)""",
            """s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees
    FROM (SELECT DISTINCT source FROM e))""",
            """d0 AS (SELECT s.tree, row_number() OVER (PARTITION BY s.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
      count(*) OVER (PARTITION BY s.tree) AS n, leaf AS digest, doc_id, changed FROM e JOIN s ON e.source IS NOT DISTINCT FROM s.source)"""]

    def tree(name: str, count: int) -> None:
        for k in range(count):
            ctes.append(f"""{name}{k + 1} AS (SELECT tree, idx // 16 AS idx, (any_value(n) + 15) // 16 AS n,
      CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest
    FROM {name}{k} GROUP BY tree, idx // 16)""")
        for k in range(count):
            run = "PARTITION BY tree, idx // 16 ORDER BY idx ROWS BETWEEN"
            ctes.append(f"""{name}s{k} AS (SELECT tree, idx, n,
      coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
      coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")

    tree("d", levels)
    ctes.append(f"t0 AS (SELECT 0 AS tree, d.tree AS idx, s.trees AS n, d.digest FROM d{levels} d JOIN s ON d.tree = s.tree)")
    tree("t", top_levels)
    ctes.append("f0 AS (SELECT doc_id, tree, idx AS i, digest AS leaf, coalesce(changed, digest) AS got, '' AS proof FROM d0)")
    steps = [(f"ds{k}", f"f.tree = x.tree AND f.i // {16 ** k} = x.idx") for k in range(levels)]
    steps += [(f"ts{k}", f"f.tree // {16 ** k} = x.idx") for k in range(top_levels)]
    for k, (level, on) in enumerate(steps):
        ctes.append(f"""f{k + 1} AS (SELECT doc_id, f.tree, i, leaf, CASE WHEN n = 1 THEN got ELSE sha256(l || got || r) END AS got,
      CASE WHEN n = 1 THEN proof ELSE proof || l || r END AS proof FROM f{k} f JOIN {level} x ON {on})""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, t0.digest AS subroot, t{top_levels}.digest AS root, sha256(proof) AS proof_sha256, got AS folded_root,
  got = t{top_levels}.digest AS verified
FROM f{len(steps)} f JOIN t0 ON t0.idx = f.tree, t{top_levels}"""


OP13_SQL = _merkle_sql()


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2_SQL, "op3_substring_dedup": OP3_SQL, "op6_minhash_dedup": OP6_SQL, "op13_merkle_manifest": OP13_SQL}
