"""The registered queries of this subpackage and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coldshelf.llm import (
    collocations,
    decontaminate,
    langid,
    licenses,
    packing,
    pieces,
    pii,
    pivots,
    prefix_trie,
    quality,
    simhash,
    token_files,
    url_filter,
)
from coldshelf.llm.shared import written
from coldshelf.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of an id as text; of an empty text where it is null."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(id_crc() % 5 != 0))
    found = langid.detect(spark, docs, model)
    return found.select("doc_id", (id_crc() % 5 == 0).alias("held_out"), "lang_pred", "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by SimHash."""
    found = simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, checked against sentencepiece and by decoding."""
    return pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, and where each document lies in them, as read back from them."""
    path = scratch_dir(spark, "token-files")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(spark, table(spark, sf_dir, "documents"), path, vocabulary)
    return token_files.token_index(spark, path)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    return quality.train(docs, table(spark, sf_dir, "labels").where(id_crc() % 4 != 2))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from the labels of three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    found = quality.scored(spark, docs, quality_model(spark, docs, sf_dir))
    return found.select("doc_id", (id_crc() % 4 == 2).alias("held_out"), "score", "predicted")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision on every page's url."""
    return url_filter.judge(spark, table(spark, sf_dir, "pages"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark items, with the share of the item that they hold."""
    found = decontaminate.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("content")


def op8_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all embeddings for each whose vec_id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return pivots.top_k(spark, vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each begun with turns of the one whose id is the next lower multiple of five."""
    turns = written(spark, prefix_trie.ordered_turns(spark, table(spark, sf_dir, "conversations")), "ordered-turns")
    return prefix_trie.prefix_trie(spark, *rebuilt(spark, turns))


def rebuilt(spark: SparkSession, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of all rebuilt conversations, and the ids of all, turnless ones included."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    head = (id_crc("conv_id") % 9).alias("head")
    convs = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), head)
    found = convs.join(sizes.toDF("base", "n"), "base", "left")
    taken = F.least("head", F.coalesce("n", F.lit(0))).alias("taken")
    convs = written(spark, found.select("conv_id", "base", "head", taken), "convs")
    first = turns.where((F.col("pos") <= 8) & (F.col("conv_id") % 5 == 0)).withColumnRenamed("conv_id", "base")
    before = convs.join(first, "base").where(F.col("pos") <= F.col("taken"))
    own = turns.join(convs, "conv_id").where(F.col("pos") > F.col("head"))
    own = own.withColumn("pos", F.col("pos") - F.col("head") + F.col("taken"))
    columns = ["conv_id", "pos", "content", "n_bytes"]
    return before.select(columns).union(own.select(columns)), convs.select("conv_id")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words stand together most above chance."""
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces, packed into sequences of 2048."""
    pieces = packing.cut(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(spark, pieces)


QUERIES: dict[str, Query] = {
    "op1_language": op1_language,
    "op2_simhash": op2_simhash,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_token_files": op4_token_files,
    "op5_quality": op5_quality,
    "op6_url_filter": op6_url_filter,
    "op7_decontaminate": op7_decontaminate,
    "op8_pivot_search": op8_pivot_search,
    "op9_personal_data": op9_personal_data,
    "op10_license_scan": op10_license_scan,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_collocations": op12_collocations,
    "op13_best_fit": op13_best_fit,
}

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)"
RULES_SQL = "(VALUES " + ", ".join(map(str, url_filter.RULES)) + ") AS rules(action, rule_host, rule_path)"


def host_sql(url: str) -> str:
    return f"translate(coalesce(regexp_extract({url}, '{PARTS}', 1), ''), '{url_filter.UPPER}', '{url_filter.LOWER}')"


def path_sql(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '{PARTS}', 2), '')"


def node_sql(url: str) -> str:
    shown = rf"regexp_replace(regexp_extract({url}, '{PARTS}', 3), '[?&](?:utm_[^&]*|gclid=[^&]*|fbclid=[^&]*)', '', 'g')"
    path = f"regexp_replace({path_sql(url)}, '/+$', '')"
    return f"CASE WHEN {host_sql(url)} <> '' THEN {host_sql(url)} || {path} || regexp_replace({shown}, '^&', '?') END"


def rule_sql(host: str, path: str) -> str:
    """The longest fitting rule as a struct, NULL without one."""
    return f"""(SELECT arg_max({{'action': action, 'rule': rule_host || rule_path}}, length(rule_host || rule_path))
            FROM {RULES_SQL}
            WHERE ({host} = rule_host OR ends_with({host}, '.' || rule_host)) AND starts_with({path}, rule_path))"""


URL_FILTER_SQL = rf"""
    WITH RECURSIVE tags AS (
        SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM pages
    ), found AS (
        SELECT url, CASE
            WHEN regexp_matches(tag, '(?is)^<link\b.*\brel\s*=\s*["'']?canonical\b')
                THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)
            WHEN regexp_matches(tag, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b')
                THEN regexp_extract(tag, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1) END AS link
        FROM tags
    ), linked AS (
        SELECT url, CASE
            WHEN regexp_matches(link, '(?i)^[a-z][a-z0-9+.-]*://') THEN link
            WHEN starts_with(link, '//') THEN 'http:' || link
            WHEN starts_with(link, '/') THEN 'http://' || {host_sql("url")} || link
            WHEN link <> '' THEN 'http://' || {host_sql("url")} || regexp_replace({path_sql("url")}, '[^/]*$', '') || link
            END AS target
        FROM found WHERE link IS NOT NULL
    ), ends AS (
        SELECT {node_sql("url")} AS a, {node_sql("target")} AS b FROM linked
    ), edges AS (
        SELECT a, b FROM ends WHERE a <> b UNION SELECT b, a FROM ends WHERE a <> b
    ), reach AS (
        SELECT a AS node, a AS other FROM edges UNION SELECT node, b FROM reach JOIN edges ON other = a
    ), judged AS (
        SELECT DISTINCT other, regexp_extract(other, '^[^/?]*') AS host,
            regexp_extract(other, '^[^/?]*([^?]*)', 1) || '/' AS path FROM reach
    ), acted AS (
        SELECT other, {rule_sql("judged.host", "judged.path")} AS found FROM judged
    ), aliased AS (
        SELECT node, CASE WHEN bool_or(found.action = 'allow') THEN 'allow'
            WHEN bool_or(found.action = 'block') THEN 'block' END AS verdict
        FROM reach JOIN acted USING (other) GROUP BY node
    ), parts AS (
        SELECT page_id, {host_sql("url")} AS host, {path_sql("url")} AS path, {node_sql("url")} AS node FROM pages
    ), ruled AS (
        SELECT *, {rule_sql("parts.host", "parts.path")} AS found FROM parts
    )
    SELECT page_id, host, path, found.rule AS rule, coalesce(found.action, aliased.verdict, 'allow') AS verdict
    FROM ruled LEFT JOIN aliased USING (node)
"""

COLLOCATIONS_SQL = r"""
    WITH parts AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS part
        FROM documents
    ), pieces AS (
        SELECT lang, list_filter(regexp_split_to_array(part, '[\x20\x09]+'), lambda w: w <> '') AS words FROM parts
    ), placed AS (
        SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
    ), grams AS (
        SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase
        FROM placed, (SELECT unnest([1, 2, 3, 4, 5]) AS k) AS sizes WHERE i + k - 1 <= len(words)
    ), counted AS (
        SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100
    ), totals AS (
        SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang
    ), longer AS (
        SELECT lang, f AS inside_f, unnest([
            array_to_string(string_split(phrase, ' ')[1 : k - 1], ' '), array_to_string(string_split(phrase, ' ')[2 : k], ' ')
        ]) AS phrase FROM counted WHERE k > 2
    ), grown AS (
        SELECT lang, phrase, max(inside_f) AS inside_f FROM longer GROUP BY lang, phrase
    ), kept AS (
        SELECT c.* FROM counted AS c LEFT JOIN grown AS g USING (lang, phrase)
        WHERE k > 1 AND (inside_f IS NULL OR 100 * inside_f < 100 * f)
    ), cuts AS (
        SELECT lang, phrase, k, f, unnest(range(1, k)) AS cut FROM kept
    ), scored AS (
        SELECT c.lang, c.phrase, c.cut, c.f AS a, x.f AS l, y.f AS r, n,
            ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM cuts AS c JOIN totals USING (lang)
        JOIN counted AS x ON x.lang = c.lang AND x.phrase = array_to_string(string_split(c.phrase, ' ')[1 : c.cut], ' ')
        JOIN counted AS y ON y.lang = c.lang AND y.phrase = array_to_string(string_split(c.phrase, ' ')[c.cut + 1 : c.k], ' ')
    ), lowest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    )
    SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score
    FROM lowest WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
    QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op12_collocations": COLLOCATIONS_SQL,
    "op6_url_filter": URL_FILTER_SQL,
    "op8_pivot_search": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), asked AS (
            SELECT DISTINCT ON (vec_id) vec_id AS query_id, vec AS query FROM usable WHERE vec_id % 50 = 0
        ), scored AS (
            SELECT query_id, vec_id,
                list_sum(list_transform(list_zip(query, vec), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM asked JOIN usable ON query_id <> vec_id AND len(query) = len(vec)
        )
        SELECT query_id, row_number() OVER best AS rank, vec_id, score
        FROM scored
        WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY rank <= 5
    """,
}
