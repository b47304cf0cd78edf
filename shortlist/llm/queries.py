"""The numbered queries over the whole tables, with their SQL."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from . import (
    benchmarks,
    chat,
    fuzzy_lines,
    licenses,
    mixing,
    mixing_lm,
    near_docs,
    passages,
    quality,
    registry,
    secrets,
    toxicity,
    vector_codes,
    whitening,
)
from .common import remainder, table
from .registry import query

PROBE = "</s>[INST] ok [/INST]"
WORDS_SQL = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


@query(
    "op1_pareto_mix",
    f"""WITH sized AS (SELECT doc_id, source, CAST({WORDS_SQL} AS BIGINT) AS size FROM documents),
      sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
      numbered AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
          WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM sources),
      walked AS (SELECT *, row_number() OVER o AS k,
          coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
          sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
          (SELECT sum(source_size) FROM sources) AS total
        FROM numbered WINDOW o AS (ORDER BY source_size / CAST(w AS DOUBLE), source NULLS LAST)),
      levels AS (SELECT k, (CAST(1.5 AS DOUBLE) * total - CAST(2 AS DOUBLE) * fixed) / CAST(free AS DOUBLE) AS level
        FROM walked WHERE (CAST(1.5 AS DOUBLE) * total - CAST(2 AS DOUBLE) * fixed) / CAST(free AS DOUBLE) * w
          < CAST(2 AS DOUBLE) * source_size ORDER BY k LIMIT 1),
      aimed AS (SELECT source, source_size, least(CAST(2 AS DOUBLE) * source_size,
          w * coalesce((SELECT level FROM levels), CAST(0 AS DOUBLE))) AS target FROM numbered),
      joined AS (SELECT doc_id, s.source, size, source_size, target,
          CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS wanted,
          (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE))
            / CAST(4503599627370496 AS DOUBLE) AS u
        FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source),
      ranked AS (SELECT *, floor(wanted) AS whole, wanted - floor(wanted) AS rest FROM joined),
      placed AS (SELECT *, CASE WHEN rest > 0 THEN coalesce(sum(size) OVER (PARTITION BY source, rest > 0
          ORDER BY u / (1 - u) / (rest / (1 - rest)), doc_id NULLS FIRST, size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS before FROM ranked)
      SELECT doc_id, size, source_size, target, CAST((whole + CASE WHEN rest > 0
          AND before + size / CAST(2 AS DOUBLE) <= greatest(0, target - whole * source_size) THEN 1 ELSE 0 END) * size AS BIGINT)
        AS taken FROM placed""",
)
def _op1(spark, sf_dir):
    mixed = mixing.pareto_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op2_context_mixing")
def _op2(spark, sf_dir):
    held_out = remainder(F.col("doc_id"), 10) == 0
    scored = mixing_lm.score(table(spark, sf_dir, "documents"), ~held_out)
    bits = F.when(F.col("bytes") > 0, -F.col("score") * math.log2(10) / F.col("bytes"))
    return scored.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        *("n_tokens", "n_known", "train_tokens", "base_score", "score"),
        bits.alias("bits_per_byte"),
    )


@query("op3_toxicity")
def _op3(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = toxicity.fit(docs, labels.filter(~held_out))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


@query("op4_secret_scan")
def _op4(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secrets")
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias("n_" + kind) for kind in secrets.KINDS[:3]
    ]
    base = F.filter(spans, lambda s: s["kind"] != "cnn")
    return found.select(
        "doc_id", *counts, F.sha2(secrets.as_text(base), 256).alias("base_sha256"), secrets.as_text(spans).alias("spans")
    )


@query("op5_license_scan")
def _op5(spark, sf_dir):
    scanned = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = F.col("license")
    return scanned.select(
        "doc_id",
        *[found[c].alias(c) for c in ("n_words", "n_base", "first_word", "last_word")],
        F.array_join(found["base_labels"], ",").alias("base_labels"),
        F.array_join(found["labels"], ",").alias("labels"),
        found["score"].alias("score"),
    )


@query("op6_fuzzy_lines")
def _op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = fuzzy_lines.deduplicate(docs, max_bits=None, min_words=1)
    return kept.select(
        "doc_id",
        F.size("removed").cast("bigint").alias("n_removed"),
        F.array_join("removed", ",").alias("removed"),
        F.char_length("text").cast("bigint").alias("kept_chars"),
    )


@query("op7_simhash_near_dedup")
def _op7(spark, sf_dir):
    linked = near_docs.near_duplicates(table(spark, sf_dir, "documents"))
    return linked.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query(
    "op8_chat_round_trip",
    rf"""WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
      quoted AS (SELECT *, length(regexp_replace(text, '{chat.ESCAPABLE}', '\1\2\\\3', 'g')) + length(regexp_replace(
          replace(replace(role, '%', '%25'), chr(10), '%0A'), '{chat.ESCAPABLE}', '\1\2\\\3', 'g'))
          + {len(chat.START) + len(chat.END) + 2} AS chars FROM said)
      SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
        sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text))
          AS loss_sha256,
        CAST(sum(chars) AS BIGINT) AS formatted_chars FROM quoted GROUP BY conv_id""",
)
def _op8(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], said.schema)
    formatted = chat.format_conversations(said.unionByName(probe))
    digests = chat.read_back(formatted)
    whole = F.concat_ws("", F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n"))))
    trained = F.concat_ws("", "trained")
    return digests.select(
        "conv_id",
        F.size("roles").cast("bigint").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length(trained).cast("bigint").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )


@query("op9_quality_rules")
def _op9(spark, sf_dir):
    rated = quality.rate(table(spark, sf_dir, "documents"))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return rated.select(*columns)


@query("op10_benchmark_leaks")
def _op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = benchmarks.leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query("op11_whiten_embeddings")
def _op11(spark, sf_dir):
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    by_component = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "at")
    columns = ("vec_id", "n", "deviation", "identity_error", by_component)
    return whitened.select(*columns).select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "at.whitened", "at.explained", "identity_error"
    )


@query(
    "op12_repeated_passages",
    r"""WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
      keyed AS (SELECT doc_id, unnest(list_transform(range(0, greatest(0, len(words) - 49)), lambda s:
          {'s': s, 'k': md5(array_to_string(list_slice(words, s + 1, s + 50), ' '))}), recursive := true) FROM texts),
      firsts AS (SELECT k, min(doc_id) AS m FROM keyed GROUP BY k),
      hits AS (SELECT doc_id, s FROM keyed JOIN firsts USING (k) WHERE doc_id > m),
      gone AS (SELECT DISTINCT doc_id, s + o AS place FROM hits, range(50) AS r(o)),
      said AS (SELECT doc_id, unnest(range(0, len(words))) AS place, unnest(words) AS word FROM texts),
      kept AS (SELECT said.doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
        FROM said ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
      SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(text, '')) AS kept_sha256 FROM texts LEFT JOIN kept USING (doc_id)""",
)
def _op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = passages.remove_repeats(docs)
    return found.select("doc_id", "passages.n_words", "passages.n_removed", F.sha2("passages.kept", 256).alias("kept_sha256"))


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Codes by comparing every part with every entry; each round is a step of its own."""
    steps = [
        """kept AS (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * 256) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda c: coalesce(NOT isfinite(c), true))) = 0)""",
        f"""cut AS (SELECT vec_id, label, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS x
        FROM kept, range({parts}) AS r(p))""",
        f"""book0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM cut
        QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {entries})""",
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""far{k} AS (SELECT vec_id, label, cut.p, e, x, list_sum(list_transform(list_zip(x, c),
          lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM cut JOIN book{k} AS b ON cut.p = b.p)"""
        )
        steps.append(
            f"""near{k} AS (SELECT * FROM far{k} QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1)"""
        )
        if k < rounds:
            steps.append(
                f"""sums{k} AS (SELECT p, e, i, CAST(floor(CAST(sum(x[i]) AS DOUBLE) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS c
        FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM near{k}) AS s GROUP BY p, e, i)"""
            )
            steps.append(f"""moved{k} AS (SELECT p, e, list(c ORDER BY i) AS c FROM sums{k} GROUP BY p, e)""")
            steps.append(f"""book{k + 1} AS (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} AS b LEFT JOIN moved{k} AS m USING (p, e))""")
    return (
        "WITH " + ", ".join(steps) + f""", coded AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code,
          CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id, label)
      SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256 FROM coded"""
    )


@query("op13_vector_codes", _codes_sql())
def _op13(spark, sf_dir):
    coded = vector_codes.encode(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
