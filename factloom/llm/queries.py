"""The registered queries of this subpackage and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import (
    bpe,
    collocations,
    decontamination,
    extraction,
    fim,
    kdtree,
    language,
    pii,
    simhash,
    substring,
    token_files,
    topk,
    urls,
)
from factloom.llm.store import shipped

Query = Callable[[SparkSession, str], DataFrame]
SHARDS = 8
END_ID = 2
#: Rules of the URL query: host, path, action.
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.new_folder(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    bases = token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, path, END_ID)
    return token_files.read_token_files(bases, folder)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.fit(pages))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kdtree.kd_shards(_table(spark, sf_dir, "documents"), shards=SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, action)")
    return urls.filter_urls(_table(spark, sf_dir, "pages"), rules)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle(_table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_decontamination, op2_language_id, op3_token_files, op4_html_extraction, op5_sharding, op6_bpe, op7_top_k,
    op8_substring_dedup, op9_url_filter, op10_simhash, op11_fill_in_middle, op12_personal_data, op13_collocations, pipeline)}

_WORDS = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def _shingles(table: str, key: str) -> str:
    return (
        f"SELECT DISTINCT {key}, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]"
        " ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle"
        f" FROM (SELECT {key}, {_WORDS} AS w FROM {table})"
    )


def _ngrams(size: int) -> str:
    return (
        f"SELECT lang, {size} AS size, unnest(list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))) AS phrase"
        f" FROM pieces WHERE len(w) >= {size}")


def _draw(n: int) -> str:
    return f"CAST('0x' || substr(digest, {8 * n - 7}, 8) AS bigint)"


ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": f"""
        WITH wanted AS ({_shingles('benchmark', 'item_id')}), held AS ({_shingles('documents', 'doc_id')}),
        sizes AS (SELECT item_id, count(*) AS n_shingles FROM wanted GROUP BY item_id)
        SELECT doc_id, item_id, n_shingles, count(*) AS n_found, count(*) / n_shingles AS containment
        FROM held JOIN wanted USING (shingle) JOIN sizes USING (item_id)
        GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= 0.8 * n_shingles - 1e-9""",
    "op7_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS double)) AS bigint)) AS x
                   FROM embeddings),
        scores AS (SELECT q.vec_id AS query_id, c.vec_id,
                          CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS bigint) AS score
                   FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS int) AS rank, vec_id, score
        FROM scores QUALIFY rank <= 20""",
    "op8_substring_dedup": """
        WITH docs AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                                                 lambda w: w <> '') AS words FROM documents),
        windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS passage
                    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs)),
        firsts AS (SELECT passage, min(doc_id) AS first_doc FROM windows GROUP BY passage),
        gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS place
                 FROM windows JOIN firsts USING (passage) WHERE first_doc < doc_id),
        places AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id)
        SELECT doc_id, CAST(len(words) AS bigint) AS n_words, CAST(coalesce(len(places), 0) AS bigint) AS n_removed,
               sha256(array_to_string(CASE WHEN places IS NULL THEN words
                   ELSE list_filter(words, lambda w, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
        FROM docs LEFT JOIN places USING (doc_id)""",
    "op9_url_filter": f"""
        WITH rules(rule_host, rule_path, action) AS (VALUES {', '.join(str(r) for r in RULES)}),
        parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path FROM pages),
        fits AS (SELECT DISTINCT host, path, rule_host || rule_path AS rule, action FROM parts JOIN rules
                 ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
        best AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
                 FROM fits GROUP BY host, path)
        SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM parts LEFT JOIN best USING (host, path)""",
    "op11_fill_in_middle": f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS digest,
                             regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units
                      FROM documents),
        drawn AS (SELECT *, len(units) AS n, {_draw(1)} % (len(units) + 1) AS x, {_draw(2)} % (len(units) + 1) AS y,
                         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {_draw(3)} % 100 >= 50 THEN 'plain'
                              WHEN {_draw(4)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM docs),
        parts AS (SELECT *, array_to_string(list_filter(units, lambda u, i: i <= least(x, y)), '') AS prefix,
                         array_to_string(list_filter(units, lambda u, i: i > least(x, y) AND i <= greatest(x, y)), '') AS middle,
                         array_to_string(list_filter(units, lambda u, i: i > greatest(x, y)), '') AS suffix FROM drawn)
        SELECT doc_id, CAST(n AS bigint) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                                ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256 FROM parts""",
    "op13_collocations": f"""
        WITH split AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
        pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM split),
        words AS (SELECT lang, CAST(sum(len(w)) AS bigint) AS n FROM pieces GROUP BY lang),
        f AS (SELECT lang, size, phrase, count(*) AS a FROM ({' UNION ALL '.join(_ngrams(k) for k in (1, 2, 3, 4))}) GROUP BY ALL HAVING count(*) >= 30),
        candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
        cuts AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
        scored AS (SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, CAST(2000000::hugeint * c.a // (x.a::hugeint + y.a) AS bigint) AS score
                   FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
                   JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        sizes AS (SELECT *, unnest(range(2, size)) AS m FROM candidates),
        inner_parts AS (SELECT lang, a AS longer, unnest(list_transform(range(1, size - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM sizes),
        gone AS (SELECT DISTINCT b.lang, b.phrase FROM best b JOIN inner_parts p ON p.lang = b.lang AND p.phrase = b.phrase
                 WHERE 100::hugeint * p.longer >= 80::hugeint * b.a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM best ANTI JOIN gone USING (lang, phrase) JOIN words USING (lang) QUALIFY rank <= 2000""",
}
