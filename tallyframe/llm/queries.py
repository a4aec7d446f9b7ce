"""Every operator of this subpackage over its whole table, beside the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitslices, decontam, dialogue, jaccard, licenses, linededup, mixing, privacy, quality, ranked, rules, sharding, suffixdedup
from .registry import ORACLES, QUERIES, query, table
from .store import stored

__all__ = ["ORACLES", "QUERIES"]

MAX_SOURCES = 10_000


@query(
    "op1_line_dedup",
    r"""WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
    keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
    frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
    FROM keyed LEFT JOIN frequent f USING (key) GROUP BY doc_id""",
)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    index = linededup.LineIndex.of(docs, least=10, n_shards=64)
    return index.drop_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op3_sharding")
def sharded(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = sharding.shards(slim, "doc_id", [1.0] * 16, ties=["size", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
        sharding.shard_of("doc_id", [1.0] * 17).alias("grown_shard"),
    )


@query(
    "op5_decontamination",
    r"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    spots AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(greatest(len(w) - 9, 1))) AS pos FROM b WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item_id, n, array_to_string(w[pos + 1 : pos + n], ' ') AS run FROM spots),
    lengths AS (SELECT DISTINCT n FROM windows),
    starts AS (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS pos FROM d, lengths WHERE len(w) >= n),
    hits AS (SELECT s.doc_id, s.pos, s.n, x.item_id FROM starts s JOIN windows x
             ON x.n = s.n AND x.run = array_to_string(s.w[s.pos + 1 : s.pos + s.n], ' ')),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
)
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontam.decontaminate(docs, table(spark, folder, "benchmark"), n=10, remove=None)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def source_weights(names: list[str | None]) -> dict[str | None, float]:
    """Weights 1, 2, 3, repeating, over the sources by code point, NULL last."""
    ordered = sorted(n for n in names if n is not None) + [None] * (None in names)
    return {n: i % 3 + 1 for i, n in enumerate(ordered)}


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


@query(
    "op10_mixing",
    r"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
    c AS (SELECT *, 3 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s),
    o AS (SELECT *, total - coalesce(sum(cap) OVER before, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open
          FROM c WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    f AS (SELECT *, rest * weight < cap * open AS free FROM o),
    level AS (SELECT max(rest) AS rest, max(open) AS open FROM f WHERE free),
    t AS (SELECT f.source, source_size, CASE WHEN free THEN CAST(level.rest * weight AS DOUBLE) / level.open ELSE CAST(cap AS DOUBLE) END AS target FROM f, level),
    q AS (SELECT *, CAST(round_even(target, 0) AS BIGINT) AS flow FROM t),
    p AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.flow,
                 coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('0:' || coalesce(CAST(d.doc_id AS VARCHAR), chr(0) || 'null'))[1:13], d.doc_id, d.size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
    SELECT doc_id, size, source_size, target,
           CAST(CASE WHEN size = 0 THEN 0 ELSE (flow // source_size) * size + least(greatest(flow % source_size - before, 0), size) END AS BIGINT) AS taken FROM p""",
)
def mixed_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = stored(table(spark, folder, "documents").select("doc_id", "source", n_words("text").alias("size")))
    held = docs.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(held) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    weights, sizes = source_weights([r["source"] for r in held]), {r["source"]: r["n"] for r in held}
    targets = mixing.quotas([sizes[s] for s in weights], list(weights.values()))
    goals = spark.createDataFrame([(s, sizes[s], t) for s, t in zip(weights, targets)], "goal_source string, source_size long, target double")
    mixed = mixing.mix(docs.withColumn("sources", F.array("source")), "doc_id", "size", "sources", weights, seed=0, most=3)
    joined = mixed.join(F.broadcast(goals), F.col("source").eqNullSafe(F.col("goal_source")))  # at most MAX_SOURCES rows
    return joined.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels").select("doc_id", "quality"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query(
    "op9_jaccard_join",
    r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[pos + 1 : pos + 5], ' ')) AS h, array_to_string(w[pos + 1 : pos + 5], ' ') AS run
          FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS pos FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    meet AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM meet JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id
    FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)""",
)
def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"), "doc_id", "text", n=5, percent=80)


@query("op2_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.quality_rules(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_pii_surrogates")
def pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    replaced = privacy.replace_personal(docs, key="tallyframe")
    return replaced.select("doc_id", "text", "n_entities", F.array_join("entities", ",").alias("entities"))


@query(
    "op8_license_scan",
    f"""WITH known AS (SELECT sha256({licenses.sql_canonical("t")}) AS digest, min(id) AS id
                   FROM (VALUES {", ".join("('%s', '%s')" % (k, v.replace("'", "''")) for k, v in licenses.KNOWN.items())}) v(id, t) GROUP BY 1),
    lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
    found AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT id, ',' ORDER BY id) AS ids
              FROM lines JOIN known ON digest = sha256({licenses.sql_canonical("line")}) GROUP BY doc_id),
    d AS (SELECT doc_id, {licenses.sql_canonical("text")} AS kept FROM documents)
    SELECT doc_id, CASE WHEN kept <> '' THEN sha256(kept) END AS canonical_sha256, known.id AS license_id,
           coalesce(ids, '') AS line_licenses, coalesce(n, 0) AS n_license_lines
    FROM d LEFT JOIN known ON kept <> '' AND digest = sha256(kept) LEFT JOIN found USING (doc_id)""",
)
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents").select("doc_id", "text"), licenses.known_licenses(spark))
    return found.select("doc_id", "canonical_sha256", "license_id", F.array_join("line_licenses", ",").alias("line_licenses"), "n_license_lines")


@query("op6_suffix_dedup")
def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffixdedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"), width=200)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op13_topk_bitslices",
    """WITH v AS (SELECT vec_id, row_number() OVER () AS place, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.place, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
          FROM v a JOIN v b ON a.place <> b.place WHERE a.vec_id % 20 = 0)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score
    FROM s QUALIFY rank <= 20""",
)
def topk_bitslices(spark: SparkSession, folder: str) -> DataFrame:
    return bitslices.top_products(table(spark, folder, "embeddings"), "vec_id", "embedding", k=20, every=20, scale=64.0)


@query(
    "op11_ranked_search",
    r"""WITH t AS (SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    total AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM t WHERE len(w) > 0),
    d AS (SELECT place, doc_id, 100 - 50 + (50 * len(w) * docs) // terms AS m FROM t, total WHERE len(w) > 0),
    b AS (SELECT item, item_id, unnest(list_distinct(w)) AS term FROM (SELECT row_number() OVER () AS item, item_id,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark)),
    p AS (SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(w) AS term FROM t) WHERE term IN (SELECT term FROM b) GROUP BY ALL),
    f AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, total GROUP BY term),
    s AS (SELECT item, item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
          FROM b JOIN f USING (term) JOIN p USING (term) JOIN d USING (place) GROUP BY item, item_id, doc_id, place)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM s WHERE score > 0 QUALIFY rank <= 50""",
)
def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.best_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=50)


def _edit(value: str, cost: str, letter: str) -> str:
    """SQL: a path (cost in 12 digits, then its audit) with one more edit; NULL stays NULL."""
    return f"printf('%012d', CAST({value}[1:12] AS BIGINT) + {cost}) || {value}[13:] || '{letter}'"


def _steps(to: str, initial: str | None, sources: list[str]) -> str:
    """SQL: the least path into a last role, from paths ``sources`` to the roles before it, over one row."""
    ways = [_edit(f"p.{to}", "2", "D")]
    for source in sources:
        if initial is not None:
            ways.append(f"CASE WHEN r.stays AND r.initial = '{initial}' THEN {_edit('p.' + source, '5 * r.cut', 'K')} END")
        if to in ("u", "a"):
            ways.append(f"CASE WHEN r.stays THEN {_edit('p.' + source, '1 + 5 * r.cut', 'R')} END")
    return f"least({', '.join(ways)})"


@query(
    "op12_conversation_repair",
    rf"""WITH RECURSIVE known AS (SELECT row_number() OVER () AS place, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS name FROM conversations),
    crc AS (SELECT *, 4294967295 - list_reduce(list_transform(range(len(name)), lambda i: CAST(ord(name[i + 1]) AS BIGINT)),
                lambda c, b: list_reduce([xor(c, b)] || range(8), lambda v, i: xor(v >> 1, 3988292384 * (v & 1))), CAST(4294967295 AS BIGINT)) AS crc FROM known),
    hurt AS (SELECT conv_id, turn, place, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role,
        CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE crc % 20 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM crc),
    named AS (SELECT DISTINCT conv_id FROM conversations),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, place, copy) AS i,
                      regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last_char FROM hurt),
    judged AS (SELECT *, last_char = '' AS blank, last_char <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed),
    r AS (SELECT *, NOT blank AND NOT again AS stays, CAST(NOT blank AND NOT again AND last_char NOT IN ('.', '!', '?') AS INTEGER) AS cut, role[1:1] AS initial,
                 lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM judged),
    p AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000000000' AS o, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM named
          UNION ALL SELECT p.conv_id, r.i, {_edit("p.o", "2", "D")}, {_steps("s", "s", ["o"])}, {_steps("u", "u", ["o", "s", "a"])}, {_steps("a", "a", ["u"])}
          FROM p JOIN r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i + 1),
    done AS (SELECT conv_id, arg_max(least(o, a), i) AS path FROM p GROUP BY conv_id),
    edited AS (SELECT r.*, path[12 + i:12 + i] AS letter FROM r JOIN done ON r.conv_id IS NOT DISTINCT FROM done.conv_id),
    numbered AS (SELECT *, count(*) OVER w - 1 - max(CASE WHEN letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER w AS pos FROM edited WHERE letter <> 'D' WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
    written AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN pos % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS body FROM numbered GROUP BY conv_id),
    counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again) AS duplicate,
                       count(*) FILTER (WHERE cut = 1) AS truncated, count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
    SELECT done.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
           CAST(path[1:12] AS BIGINT) AS cost, path[13:] AS audit, sha256(coalesce(body, '')) AS repaired_sha256
    FROM done LEFT JOIN counted ON done.conv_id IS NOT DISTINCT FROM counted.conv_id LEFT JOIN written ON done.conv_id IS NOT DISTINCT FROM written.conv_id""",
)
def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    judged, turns = dialogue.repair(dialogue.damage(table(spark, folder, "conversations")))
    hashed = dialogue.digests(turns).withColumnRenamed("conv_id", "hashed_conv")
    both = judged.join(hashed, F.col("conv_id").eqNullSafe(F.col("hashed_conv")), "left")
    return both.select(*judged.columns, F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
