"""One query per operator, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transhume.llm import chat, codes, decontaminate, langid, lines, packing, pages, quality, repair, rules, sharding, simhash, trie
from transhume.llm.text import split_of
from transhume.queries.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: A document is good from this score on.
GOOD = 0.7

#: Vocabulary for packing; the path is a parameter of the operator.
TOKENIZER = "word_bpe_49k.json"


def register(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    """The quarter of the documents that no model learns from."""
    return split_of(F.col("doc_id")) == 2


@register()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; profiles from the three quarters that are not held out."""
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn(docs.where(~held_out()))
    found = langid.identify(docs.select("doc_id", "text"), profiles, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@register()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document: three-word shingles, three bits."""
    found = simhash.fingerprint_components(table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


@register()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels from the three quarters that are not held out."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    model = quality.fit_quality(docs.where(~held_out()), labels)
    scored = quality.score_quality(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


_WORDS = r"regexp_split_to_array(lower(line), '[\x20\x09-\x0D]+')"


@register(
    rf"""
WITH raw AS (
    SELECT doc_id, md5(coalesce(text, '')) AS doc, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
           unnest(string_split(text, chr(10))) AS line
    FROM documents
), occ AS (
    SELECT doc_id, doc, pos, w, array_to_string(w, ' ') AS s
    FROM (SELECT doc_id, doc, pos, list_filter({_WORDS}, lambda x: x <> '') AS w FROM raw)
    WHERE length(array_to_string(w, ' ')) >= 8
), firsts AS (
    SELECT s, any_value(w) AS w, min(row(doc_id IS NULL, doc_id, doc, pos)) AS f FROM occ GROUP BY s
), cut AS (
    SELECT s, f, k, array_to_string(list_concat(w[1:k - 1], w[k + 1:]), ' ') AS v
    FROM (SELECT s, w, f, unnest(range(1, len(w) + 1)) AS k FROM firsts WHERE len(w) >= 8)
), near AS (
    SELECT s FROM (SELECT s, f, min(f) OVER (PARTITION BY v, k) AS g FROM cut) WHERE g < f
    UNION SELECT CASE WHEN cut.f < firsts.f THEN firsts.s ELSE cut.s END FROM cut JOIN firsts ON cut.v = firsts.s AND len(firsts.w) >= 8
), gone AS (
    SELECT doc_id, doc, count(DISTINCT pos) AS n
    FROM occ JOIN firsts USING (s)
    WHERE s IN (SELECT s FROM near) OR row(occ.doc_id IS NULL, occ.doc_id, occ.doc, occ.pos) <> f
    GROUP BY ALL
)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::INTEGER AS n_lines, coalesce(n, 0)::INTEGER AS lines_cut
FROM documents d LEFT JOIN gone ON d.doc_id IS NOT DISTINCT FROM gone.doc_id AND md5(coalesce(d.text, '')) = gone.doc
"""
)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the number of its lines that an earlier line repeats, but for a word."""
    docs = table(spark, sf_dir, "documents")
    kept = docs.select("doc_id", "text", F.greatest(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    found = lines.dedup_lines(kept, drop_emptied=False)
    return found.select("doc_id", "n_lines", "lines_cut")


def _item_words(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@register(
    f"""
WITH items AS (
    SELECT item_id, w, least(10, len(w)) AS size FROM (SELECT item_id, {_item_words("text")} AS w FROM benchmark) WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM items)
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_item_words("text")} AS w FROM documents
), placed AS (
    SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM windows))
), hits AS (
    SELECT r, item_id, i, size FROM placed JOIN windows USING (size, g)
), named AS (
    SELECT r, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS names
    FROM hits GROUP BY r
), spans AS (
    SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS k FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN named USING (r) LEFT JOIN spans USING (r)
"""
)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "_row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _share(a: str, b: str) -> str:
    return f"coalesce(({a}) / nullif(({b})::DOUBLE, 0), 0)"


_STOPS = ", ".join(f"'{w}'" for w in sorted(set(rules.STOP_WORDS)))


@register(
    rf"""
WITH base AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n
    FROM (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM base))
), repeats AS (
    SELECT r, count(DISTINCT k) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 8)) AS k FROM windows WHERE n > 1) GROUP BY r
), measures AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
           length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS upper,
           len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS stops,
           len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]\s'))) AS bullets,
           len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS open
    FROM base LEFT JOIN repeats USING (r)
), failed AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_share("word_chars", "n_words")} BETWEEN 2 AND 12 AND {_share("n_symbols", "word_chars")} <= 0.1
       AND {_share("upper", "word_chars")} <= 0.5 AND {_share("stops", "n_words")} >= 0.03
       AND {_share("n_dup_lines", "n_lines")} <= 0.5 AND {_share("bullets", "n_lines")} <= 0.9
       AND {_share("open", "n_lines")} <= 0.9 AS kept
FROM failed
"""
)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    found = rules.measured(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rules.base_failed().alias("base_failed"), (~rules.base_failed() & rules.verdict()).alias("kept"),
    )


@register()
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = pages.main_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@register()
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of 4096 tokens."""
    found = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


#: A conversation whose texts are marks of a template.
MARKED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def _escaped(text: str) -> str:
    """SQL length of an escaped text: a backslash more for each backslash and control string."""
    controls = chat._any_of(chat.TEMPLATE.controls).replace("'", "''")
    return f"(length({text}) + length({text}) - length(replace({text}, '\\', '')) + len(regexp_extract_all({text}, '{controls}')))"


_MARKS = sum(map(len, (chat.TEMPLATE.before, chat.TEMPLATE.between, chat.TEMPLATE.after)))
_ALL_TURNS = " UNION ALL ".join(
    ["SELECT conv_id, turn, role, text FROM conversations", *(f"SELECT {c}, {t}, '{r}', '{x}'" for c, t, r, x in MARKED)]
)


@register(
    f"""
WITH turns AS (
    SELECT conv_id, turn, role IS NOT DISTINCT FROM 'assistant' AS learned, role AS r0, text AS t0,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM ({_ALL_TURNS})
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (learned), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) FILTER (learned), '')) AS loss_sha256,
       sum({_MARKS} + {_escaped("role")} + {_escaped("text")})::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
)
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(MARKED, "conv_id long, turn long, role string, text string"))
    return chat.read_back(chat.format_chats(rows))


@register()
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; sizes are near equal."""
    found = sharding.shard(table(spark, sf_dir, "documents"), shards=16)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _codes_sql() -> str:
    """Rounds of fitting one after the other, each an assignment and its means."""
    apart = "list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    nearest = "SELECT p, r, any_value(q) AS q, min([d, e]) AS best FROM (SELECT p, r, q, e, {apart} AS d FROM parts JOIN books{k} USING (p)) GROUP BY p, r"
    steps = [
        f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT p, r, v[p * (len(v) // {codes.PARTS}) + 1:(p + 1) * (len(v) // {codes.PARTS})] AS q FROM kept, range({codes.PARTS}) AS t(p)
), firsts AS (
    SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e
    FROM (SELECT vec_id, min(r) AS r FROM kept GROUP BY vec_id) ORDER BY vec_id LIMIT {codes.ENTRIES}
), books0 AS MATERIALIZED (SELECT p, e, q AS c FROM parts JOIN firsts USING (r))"""
    ]
    for k in range(codes.ROUNDS + 1):
        steps.append(f"near{k} AS MATERIALIZED ({nearest.format(apart=apart, k=k)})")
        if k < codes.ROUNDS:
            steps.append(
                f"""means{k} AS (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m
    FROM (SELECT p, best[2] AS e, i, sum(q[i]) AS s, count(*) AS n FROM near{k}, (SELECT unnest(range(1, (SELECT max(len(q)) FROM parts) + 1)) AS i) WHERE i <= len(q) GROUP BY ALL)
    GROUP BY p, e
), books{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m, c) AS c FROM books{k} LEFT JOIN means{k} USING (p, e))"""
            )
    last = codes.ROUNDS
    steps.append(
        f"""coded AS (
    SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM near{last} GROUP BY r
), digest AS (
    SELECT sha256(string_agg(c[i], ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, c, unnest(range(1, len(c) + 1)) AS i FROM books{last})
)"""
    )
    return (
        "WITH " + ", ".join(steps) + " SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256"
        " FROM kept JOIN coded USING (r), digest"
    )


@register(_codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every vector, with the errors of its label."""
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"), keep=["vec_id", "label"])
    summed = codes.with_sum_of_equals(coded, "label", "error", "label_error")
    return summed.select("vec_id", "code", "error", "label_error", F.lit(codes.codes_digest(books)).alias("codebooks_sha256"))


@register()
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation, after damage."""
    original = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.repair(repair.damaged(original))
    all_ids = original.select("conv_id").distinct()
    for more in (found.plans, repair.digests(found.rows)):
        more = more.withColumnRenamed("conv_id", "_conv")
        all_ids = all_ids.join(more, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.lit(repair.EMPTY_SHA256)).alias("repaired_sha256")
    return all_ids.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), digest)


#: Vocabulary of byte-level BPE; the path is a parameter of the operator.
BYTE_TOKENIZER = "byte_bpe_50k.json"


@register()
def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids, and of the text that they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = trie.encode(docs, public_tokenizers.path(BYTE_TOKENIZER), keep=["doc_id"], decoded=True)
    digest = lambda c, name: F.sha2(F.col(c).cast("binary"), 256).alias(name)
    return found.select("doc_id", "n_tokens", digest("ids", "ids_sha256"), digest("decoded", "decoded_sha256"))
