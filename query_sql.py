"""The SQL that each registered query must agree with, over the same tables, for another engine."""

from sluice.functions import text as tx
from sluice.plans.instruct import VAL_RATIO
from sluice.plans.pretrain import BUDGET_SOURCES

# What queries and SQL share.
SEED = 42
SHARD = 100
PAD = "\u00a0\t\u3000"
CLUSTERS, CLUSTER_GAP = 7, 2**57
LONG_TEXT = 20_000
BUDGET_RATIOS = {source.name: source.ratio for source in BUDGET_SOURCES}


def _trim(text: str) -> str:
    return f"trim({text}, {_literal(tx.WHITESPACE)})"


def _literal(value: str) -> str:
    return " || ".join(f"chr({ord(c)})" for c in value)


def _chat(separator: str) -> str:
    sep = _literal(separator)
    return (
        f"'{tx.TURN_START}user' || {sep} || {_trim('prompt')} || {sep} || '{tx.TURN_END}' || {sep} || "
        f"'{tx.TURN_START}assistant' || {sep} || {_trim('text')} || {sep} || '{tx.TURN_END}'"
    )


def _sql_parts() -> dict[str, str]:
    """Common table expressions, by name; each may use those before it."""
    marker_bytes = 2 * len(tx.TURN_START) + 2 * len(tx.TURN_END)
    both = {"newline": "\n", "literal": "\\n"}
    parts = {
        "pairs": (
            "SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS text FROM conversations u JOIN conversations a "
            "ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'"
        ),
        "estimated": (
            "SELECT doc_id, text, source, lang, greatest(1, length(text) // 4)::BIGINT AS token_count FROM documents"
        ),
    }
    for name, separator in both.items():
        parts[f"chat_{name}"] = f"SELECT *, {_chat(separator)} AS formattedconversation FROM pairs"
        parts[f"bytes_{name}"] = (
            f"SELECT *, strlen(formattedconversation) - {marker_bytes} + 4 AS tokencount FROM chat_{name}"
        )
        # The merges an, on, ion, in this order: each replaced by one byte that the text does not have.
        merged = "replace(replace(replace(formattedconversation, 'an', chr(1)), 'on', chr(2)), 'i' || chr(2), chr(3))"
        parts[f"merged_{name}"] = f"SELECT *, strlen({merged}) - {marker_bytes} + 4 AS tokencount FROM chat_{name}"
    return parts


def _sql(query: str, *uses: str) -> str:
    parts = _sql_parts()
    return f"WITH {', '.join(f'{u} AS ({parts[u]})' for u in uses)} {query}"


def _share(total: str, share: float) -> str:
    return f"CAST(trunc(CAST({total} AS DOUBLE) * {share!r}) AS BIGINT)"


def oracle_sql() -> dict[str, str]:
    newline, literal = ("pairs", "chat_newline", "bytes_newline"), ("pairs", "chat_literal", "bytes_literal")
    merged_newline, merged_literal = (*newline[:2], "merged_newline"), (*literal[:2], "merged_literal")
    per_conversation = (
        "SELECT conv_id, count(*) AS samples, sum(tokencount)::BIGINT AS tokens, max(tokencount) AS longest FROM {} GROUP BY 1"
    )
    stats_of = (
        "count(*) AS samples, coalesce(sum(tokencount), 0)::BIGINT AS total_tokens, "
        "coalesce(avg(tokencount), 0.0) AS mean_tokens, min(tokencount) AS min_tokens, max(tokencount) AS max_tokens"
    )
    by_source = "source, count(*) AS samples, sum(token_count)::BIGINT AS tokens"
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    shuffled_docs = (
        "SELECT doc_id, source, row_number() OVER (ORDER BY md5('{seed}:' || doc_id), doc_id) AS rn, "
        "count(*) OVER () AS n FROM documents"
    )
    train_size = _share("n", 1 - VAL_RATIO)
    shards = (
        "SELECT row_number() OVER (ORDER BY source, doc_id) - 1 AS position, text, source "
        "FROM documents WHERE length(text) >= 50"
    )
    half_budget = (
        f"SELECT doc_id, text, source, token_count FROM (SELECT *, coalesce(sum(token_count) OVER "
        f"(PARTITION BY source ORDER BY doc_id {earlier}), 0) AS before, sum(token_count) OVER "
        f"(PARTITION BY source) AS total FROM estimated) WHERE before < "
    )
    coupled = (
        "accepted AS (SELECT doc_id, text, token_count, CASE WHEN source = 'src0' THEN 'open_web_math' "
        "ELSE 'fineweb_edu' END AS source FROM estimated WHERE length(text) >= 50 {condition}), "
        "running AS (SELECT *, coalesce(sum(token_count) OVER (PARTITION BY source ORDER BY doc_id "
        f"{earlier}), 0) AS before FROM accepted), "
        "budget AS (SELECT sum(token_count)::BIGINT // 2 AS total FROM {whole}), "
        "web AS (SELECT running.* FROM running, budget WHERE source = 'fineweb_edu' AND "
        f"(before = 0 OR before < {_share('total', BUDGET_RATIOS['fineweb_edu'])})), "
        "spent AS (SELECT coalesce(sum(token_count), 0)::BIGINT AS spent FROM web), "
        "math AS (SELECT running.* FROM running, budget, spent WHERE source = 'open_web_math' AND spent < total "
        f"AND (before = 0 OR before < least({_share('total', BUDGET_RATIOS['open_web_math'])}, total - spent))), "
        "kept AS (SELECT *, 0::BIGINT AS source_order FROM web UNION ALL SELECT *, 1::BIGINT FROM math)"
    )
    english_web = "AND (source = 'src0' OR lang IS NULL OR lang = 'en')"
    estimated = f"estimated AS ({_sql_parts()['estimated']})"
    plan_rows = " UNION ALL ".join(
        f"SELECT '{name}' AS source, CAST({ratio!r} AS DOUBLE) AS planned_share, "
        f"{_share('5000000', ratio)} AS planned_tokens"
        for name, ratio in BUDGET_RATIOS.items()
    )
    instruct_kept = (
        "drawn AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || conv_id || ':' || turn), conv_id, turn) AS rn, "
        "count(*) OVER () AS all_rows FROM {base}), "
        "kept AS (SELECT * FROM drawn WHERE rn <= all_rows * 3 // 4), "
        "divided AS (SELECT *, row_number() OVER (ORDER BY md5('52:' || conv_id || ':' || turn), conv_id, turn) AS place, "
        "count(*) OVER () AS n FROM kept)"
    )
    instruct_sql = _sql("", *newline).rstrip() + f", {instruct_kept.format(base='bytes_newline')} "
    merged_sql = _sql("", *merged_newline).rstrip() + f", {instruct_kept.format(base='merged_newline')} "
    mixed_by_tokens = (
        f"{coupled.format(condition=english_web, whole='estimated')}, divided AS (SELECT *, row_number() OVER (ORDER BY "
        "md5('42:' || source || ':' || doc_id), source, doc_id) AS place, count(*) OVER () AS n FROM kept) "
        f"SELECT doc_id, text, source, CASE WHEN place <= {_share('n', VAL_RATIO)} THEN 'validation' ELSE 'train' END "
        "AS split FROM divided"
    )
    samples_plan = (
        "plan AS (SELECT 200 * count(*) AS total FROM documents), "
        "budgets AS (SELECT total - CAST(trunc(total * CAST(0.01 AS DOUBLE)) AS BIGINT) AS web_tokens, "
        "CAST(trunc(total * CAST(0.01 AS DOUBLE)) AS BIGINT) AS math_tokens FROM plan), "
        "drawn AS (SELECT doc_id, text, 'fineweb-edu' AS source, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) "
        "AS rn, CAST(ceil(web_tokens / 500) AS BIGINT) AS planned FROM documents, budgets WHERE source <> 'src0' "
        "UNION ALL SELECT doc_id, text, 'open-web-math', row_number() OVER (ORDER BY md5('43:' || doc_id), doc_id), "
        "CAST(ceil(math_tokens / 800) AS BIGINT) FROM documents, budgets WHERE source = 'src0'), "
        "divided AS (SELECT *, row_number() OVER (ORDER BY md5('52:' || source || ':' || doc_id), source, doc_id) AS place, "
        "count(*) OVER () AS n FROM drawn WHERE rn <= planned)"
    )
    sql = {
        "min_length_english": (
            "SELECT doc_id, text, 'web' AS source FROM documents WHERE (lang IS NULL OR lang = 'en') AND length(text) >= 50"
        ),
        "nonblank_stripped": (
            f"SELECT doc_id, {_trim('padded')} AS text FROM (SELECT doc_id, {_literal(PAD)} || text || {_literal(PAD)} "
            f"AS padded FROM documents) WHERE {_trim('padded')} <> ''"
        ),
        "string_fields": (
            "SELECT source AS id, count(*) AS n_lines, count_if(lang = 'en')::BIGINT AS n_texts, "
            "sum(CASE WHEN lang = 'en' THEN length(text) END)::BIGINT AS n_chars FROM documents GROUP BY source"
        ),
        "chat_pairs_newline": _sql("SELECT conv_id, turn, formattedconversation FROM chat_newline", *newline[:2]),
        "chat_pairs_literal": _sql("SELECT conv_id, turn, formattedconversation FROM chat_literal", *literal[:2]),
        "conformed_columns": _sql(
            "SELECT text, source, CAST(NULL AS VARCHAR) AS url, token_count FROM estimated", "estimated"
        ),
        "preview": _sql(
            "SELECT conv_id, turn, substring(formattedconversation, 1, 1000) AS preview FROM chat_newline "
            "ORDER BY md5('42:' || conv_id || ':' || turn), conv_id, turn LIMIT 1", *newline[:2],
        ),
        "token_estimate_by_source": _sql(f"SELECT {by_source} FROM estimated GROUP BY source", "estimated"),
        "token_estimate_overall": _sql(f"SELECT {by_source} FROM estimated GROUP BY ROLLUP (source)", "estimated"),
        "bpe_count_bytes": _sql(per_conversation.format("bytes_newline"), *newline),
        "bpe_count_merges": _sql(per_conversation.format("merged_newline"), *merged_newline),
        "decode_roundtrip": (
            "SELECT source, count(*) AS samples, count(*) AS same, sum(length(text))::BIGINT AS n_chars FROM documents GROUP BY 1"
        ),
        "marker_positions": _sql(
            f"SELECT conv_id, turn, '0,' || (9 + p) AS starts, (7 + p) || ',' || (21 + p + t) AS ends FROM "
            f"(SELECT conv_id, turn, strlen({_trim('prompt')}) AS p, strlen({_trim('text')}) AS t FROM pairs)", "pairs",
        ),
        "sample_inspection": (
            f"{instruct_sql} SELECT substring(formattedconversation, 1, 1000) AS preview, tokencount AS tokens, "
            f"'0,' || (9 + p) AS starts, (7 + p) || ',' || (21 + p + t) AS ends FROM (SELECT *, "
            f"strlen({_trim('prompt')}) AS p, strlen({_trim('text')}) AS t FROM divided WHERE place <= {train_size} "
            "ORDER BY rn LIMIT 1)"
        ),
        "length_capped": _sql(
            "SELECT conv_id, turn, formattedconversation, tokencount FROM bytes_literal WHERE tokencount < 508", *literal
        ),
        "token_stats": _sql(f"SELECT {stats_of} FROM bytes_newline", *newline),
        "retention": _sql(
            "SELECT *, CASE WHEN original_rows > 0 THEN CAST(filtered_rows AS DOUBLE) / original_rows * 100 ELSE 0.0 END "
            "AS retained_percent FROM (SELECT count(*) AS original_rows, count_if(tokencount < 508)::BIGINT AS filtered_rows "
            "FROM bytes_literal)", *literal,
        ),
        "first_n_seeded": " UNION ALL ".join(
            f"SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (ORDER BY md5('{seed}:' || doc_id), "
            f"doc_id) AS rn, count(*) OVER () AS n FROM documents WHERE {_trim('text')} <> '' AND source {op} 'src0') "
            f"WHERE rn <= {_share('n', 0.3)}"
            for seed, op in ((42, "<>"), (43, "="))
        ),
        "drawn_sample": (
            "SELECT doc_id, text FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn "
            "FROM documents WHERE lang IS NULL OR lang = 'en') WHERE rn <= (SELECT count(*) // 10 FROM documents)"
        ),
        "token_budget_per_source": _sql(half_budget + _share("total", 0.5), "estimated"),
        "token_budget_per_conversation": (
            f"SELECT conv_id, turn, role, token_count FROM (SELECT *, coalesce(sum(token_count) OVER (PARTITION BY conv_id ORDER BY turn {earlier}), 0) "
            "AS before, sum(token_count) OVER (PARTITION BY conv_id) AS total FROM (SELECT conv_id, turn, role, "
            f"greatest(1, length(text) // 4)::BIGINT AS token_count FROM conversations)) WHERE before < {_share('total', 0.5)}"
        ),
        "token_budget_coupled": (
            f"WITH {estimated}, {coupled.format(condition='', whole='accepted')} "
            "SELECT doc_id, source, token_count, source_order FROM kept"
        ),
        "taken_first": f"SELECT doc_id, source FROM ({shuffled_docs.format(seed=42)}) WHERE rn <= n // 4",
        "skipped_first": (
            "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) AS rn, "
            "count(*) OVER () AS n FROM documents) WHERE rn > n // 4"
        ),
        "sample_plan": _sql(
            "SELECT *, CASE WHEN primary_tokens > 0 THEN greatest(1, CAST(ceil(primary_tokens / 500) AS BIGINT)) ELSE 0 END "
            "AS primary_samples, CASE WHEN secondary_tokens > 0 THEN greatest(1, CAST(ceil(secondary_tokens / 800) AS BIGINT)) "
            "ELSE 0 END AS secondary_samples FROM (SELECT *, total_tokens - secondary_tokens AS primary_tokens FROM "
            "(SELECT *, CASE WHEN with_secondary THEN CAST(trunc(total_tokens * secondary_share) AS BIGINT) ELSE 0 END "
            "AS secondary_tokens FROM (SELECT source, (sum(token_count) * 100)::BIGINT AS total_tokens, "
            "CAST(0.01 AS DOUBLE) AS secondary_share, source <> 'src0' AS with_secondary FROM estimated GROUP BY source)))",
            "estimated",
        ),
        "mixture_share": _sql(
            f"SELECT source, planned_share, planned_tokens, coalesce(samples, 0) AS samples, coalesce(tokens, 0) AS tokens, "
            f"CAST(coalesce(tokens, 0) AS DOUBLE) / (SELECT sum(token_count) FROM estimated) AS achieved_share "
            f"FROM ({plan_rows}) LEFT JOIN (SELECT CASE WHEN source = 'src0' THEN 'open_web_math' ELSE 'fineweb_edu' END "
            f"AS source, count(*) AS samples, sum(token_count)::BIGINT AS tokens FROM estimated GROUP BY 1) USING (source)",
            "estimated",
        ),
        "progress_record": _sql(
            "SELECT sum(tokens)::BIGINT AS total_tokens, '{' || string_agg('\"' || source || '\":' || tokens, ',' ORDER BY source) "
            "|| '}' AS tokens_per_source, '{' || string_agg('\"' || source || '\":' || samples, ',' ORDER BY source) || '}' "
            f"AS examples_per_source, sum(samples)::BIGINT AS examples_collected, true AS has_time FROM (SELECT {by_source} FROM estimated "
            "GROUP BY source)", "estimated",
        ),
        "failed_checks": _sql(
            "SELECT 'share' AS \"check\", source AS subject, share <= 1 AS passed, CASE WHEN share > 1 THEN "
            "'share must lie in [0.0, 1.0], got ' || share END AS reason FROM (SELECT source, tokens / (min(tokens) OVER () * 2.0::DOUBLE) AS share "
            f"FROM (SELECT {by_source} FROM estimated GROUP BY source)) UNION ALL SELECT 'rows', source, n > 0, CASE WHEN n = 0 THEN 'no rows collected' "
            f"END FROM (SELECT source, count(CASE WHEN length(text) >= {LONG_TEXT} THEN 1 END) AS n FROM documents GROUP BY source)", "estimated",
        ),
        "split_permutation": (
            f"SELECT doc_id, source, CASE WHEN rn <= {train_size} THEN 'train' ELSE 'val' END AS split "
            f"FROM ({shuffled_docs.format(seed=52)})"
        ),
        "split_permuted_order": (
            f"SELECT doc_id, text, rn - 1 AS permuted, CASE WHEN rn <= {train_size} THEN 'train' ELSE 'val' END AS split "
            f"FROM ({shuffled_docs.format(seed=42)}) JOIN (SELECT doc_id, text FROM documents) USING (doc_id)"
        ),
        "split_take_skip": (
            f"SELECT doc_id, source, CASE WHEN rn <= {_share('n', VAL_RATIO)} THEN 'validation' ELSE 'train' END AS split "
            f"FROM ({shuffled_docs.format(seed=42)})"
        ),
        "split_sizes": (
            f"WITH n AS (SELECT count(*) AS n FROM documents), a AS (SELECT n, {_share('n', 1 - 0.015)} AS train, "
            f"{_share('n', 0.015)} AS val FROM n) SELECT 'train' AS split, train AS samples, 'permutation' AS rule FROM a "
            "UNION ALL SELECT 'val', n - train, 'permutation' FROM a UNION ALL SELECT 'validation', val, 'take_skip' FROM a "
            "UNION ALL SELECT 'train', n - val, 'take_skip' FROM a"
        ),
        "split_extremes": (
            "SELECT CAST(ratio AS DOUBLE) AS ratio, split, CASE WHEN (ratio = 0) = (split = 'train') THEN n ELSE 0 END AS samples "
            "FROM (SELECT count(*) AS n FROM documents), (VALUES (0, 'train'), (0, 'val'), (1, 'train'), (1, 'val')) AS s(ratio, split)"
        ),
        "subset_source": "SELECT doc_id, source, lang AS subset FROM documents WHERE lang IN ('en', 'fr')",
        "missing_source": (
            "SELECT 'present' AS source, count(*) AS samples, count(text) AS texts FROM documents UNION ALL SELECT 'missing', 0, 0"
        ),
        "shard_counts": (
            f"SELECT position // {SHARD} AS shard, count(*) AS samples, min(position) AS first, max(position) AS last, 1 AS files "
            f"FROM ({shards}) GROUP BY 1"
        ),
        "shard_roundtrip": f"SELECT position, text, source, position // {SHARD} AS shard FROM ({shards})",
        "bounded_files": "SELECT count(*) AS samples, true AS within_limit FROM documents",
        "split_roundtrip": (
            f"SELECT doc_id, source, CASE WHEN rn <= {train_size} THEN 'train' ELSE 'val' END AS split "
            f"FROM ({shuffled_docs.format(seed=52)})"
        ),
        "chunk_roundtrip": _sql(f"SELECT {by_source} FROM estimated GROUP BY source", "estimated"),
        "run_metadata": (
            f"{merged_sql} SELECT max(all_rows) * 3 // 4 AS target_rows, CAST({VAL_RATIO!r} AS DOUBLE) AS val_split, "
            f"42::BIGINT AS seed, count_if(place <= {train_size})::BIGINT AS train_samples, "
            f"count_if(place > {train_size})::BIGINT AS val_samples, count(*) AS total_samples, "
            "sum(tokencount)::BIGINT AS total_tokens, CAST(sum(tokencount) AS DOUBLE) / count(*) AS mean_tokens_per_sample "
            "FROM divided"
        ),
        "running_figures": _sql(
            "SELECT count(*) AS samples, sum(token_count)::BIGINT AS tokens, true AS several, true AS rising, true AS has_rate FROM estimated", "estimated"
        ),
        "written_totals": _sql(
            "SELECT count(*) AS samples, sum(token_count)::BIGINT AS tokens, true AS has_rate FROM estimated", "estimated"
        ),
        "marker_sidecar": _sql(
            "SELECT token, id::BIGINT AS id, CASE WHEN id = 256 THEN 0 ELSE 2 * (SELECT count(*) FROM pairs) END AS occurrences "
            "FROM (VALUES ('<|endoftext|>', 256), ('<|im_start|>', 257), ('<|im_end|>', 258)) AS m(token, id)", "pairs",
        ),
        "corpus_name": _sql(
            "SELECT 'budget' AS kind, 'corpus-tiny-' || printf('%.1f', tokens / 1000000) || 'Mt-' || samples || 'pt-20240506' "
            "AS name FROM t UNION ALL SELECT 'thousands', 'corpus-' || (samples // 1000) || 'K-samples-' || (tokens // 1000) || "
            "'K-tokens-512-seq' FROM t", "estimated",
        ).replace(" SELECT 'budget'", ", t AS (SELECT count(*) AS samples, sum(token_count)::BIGINT AS tokens FROM estimated) "
                  "SELECT 'budget'", 1),
        "ingest_resumed": _sql(
            "SELECT doc_id, source, token_count FROM estimated WHERE length(text) >= 50", "estimated"
        ),
        "progress_by_batch": _sql(
            f"SELECT {by_source}, CASE WHEN max(doc_id) > (SELECT median FROM middle) THEN 1 ELSE 0 END AS last_batch "
            "FROM estimated GROUP BY source", "estimated",
        ).replace("WITH ", "WITH middle AS (SELECT quantile_disc(doc_id, 0.5) AS median FROM documents), ", 1),
        "stream_budget": _sql(
            f"SELECT doc_id, source, token_count FROM ({half_budget} total // 2)", "estimated"
        ),
        "stream_budget_coupled": (
            f"WITH {estimated}, {coupled.format(condition='', whole='accepted')} "
            "SELECT doc_id, source, token_count, source_order FROM kept"
        ),
        "instruct_corpus": (
            f"{merged_sql} SELECT conv_id, turn, {_trim('prompt')} AS prompt, {_trim('text')} AS text, "
            f"formattedconversation, tokencount, CASE WHEN place <= {train_size} THEN 'train' ELSE 'val' END AS split "
            "FROM divided"
        ),
        "instruct_capped": _sql(
            f"SELECT conv_id, turn, instruction, context, response, category, formattedconversation, tokencount, "
            f"place - 1 AS permuted, CASE WHEN place <= {train_size} THEN 'train' ELSE 'val' END AS split FROM "
            "(SELECT b.conv_id, b.turn, prompt AS instruction, s.text AS context, b.text AS response, "
            "CAST(NULL AS VARCHAR) AS category, formattedconversation, tokencount, row_number() OVER (ORDER BY "
            "md5('42:' || b.conv_id || ':' || b.turn), b.conv_id, b.turn) AS place, count(*) OVER () AS n "
            "FROM merged_literal b LEFT JOIN (SELECT conv_id, text FROM conversations WHERE role = 'system') s "
            "ON s.conv_id = b.conv_id WHERE tokencount < 508)", *merged_literal,
        ),
        "pretrain_by_samples": (
            f"WITH {samples_plan} SELECT doc_id, {_trim('text')} AS text, source, "
            f"CASE WHEN place <= {train_size} THEN 'pretrain_train' ELSE 'pretrain_val' END AS split FROM divided"
        ),
        "pretrain_by_tokens": f"WITH {estimated}, {mixed_by_tokens}",
        "pretrain_resumed": f"WITH {estimated}, {mixed_by_tokens}",
        "pretrain_resumed_sparse": (
            f"WITH clustered AS (SELECT doc_id % {CLUSTERS} * {CLUSTER_GAP} + doc_id AS doc_id, text, lang, source FROM documents), "
            + f"{estimated}, {mixed_by_tokens}".replace("FROM documents", "FROM clustered").replace("SELECT doc_id, text, source, CASE", "SELECT doc_id AS position, text, source, CASE")
        ),
        "pretrain_by_exact_tokens": (
            "WITH estimated AS (SELECT doc_id, text, source, lang, strlen(text)::BIGINT AS token_count FROM documents), "
            f"{mixed_by_tokens}"
        ),
    }
    # A job that was stopped and taken up again has the rows of one that was not.
    resumed = {"instruct_resumed": "instruct_corpus", "instruct_capped_resumed": "instruct_capped", "pretrain_by_samples_resumed": "pretrain_by_samples"}
    return sql | {name: sql[whole] for name, whole in resumed.items()}
