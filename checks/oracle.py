"""SQL counterparts of the registered queries, for DuckDB on the same tables.

Written from the definitions, not from the Spark plans: scores multiply out every token,
class totals count scored words, ranks are plain windows.
"""

from __future__ import annotations

from opinara.functions import stemming as st
from opinara.functions.wordlists import IRREGULAR_LEMMAS, STOP_WORDS


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(quoted(w) for w in words) + ")"


def with_ctes(ctes: dict[str, str], select: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + select


# Reviews and cleaning

REVIEWS = {
    "reviews": """
        SELECT d.doc_id AS review_id,
               CASE WHEN l.quality = 1 THEN CASE WHEN l.toxic = 1 THEN 4.0 ELSE 5.0 END
                    WHEN l.quality = 0 THEN CASE WHEN l.toxic = 1 THEN 1.0 ELSE 2.0 END
               END::DOUBLE AS overall,
               d.text AS "reviewText"
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
}
LOWER = """lower(coalesce("reviewText", ''))"""
WORDS = REVIEWS | {
    "tokens": f"""
        SELECT review_id, overall, [w FOR w IN string_split_regex(
            regexp_replace({LOWER}, '[^a-zA-Z\\s]', '', 'g'), '\\s+') IF w <> ''] AS words
        FROM reviews""",
    "filtered": f"""
        SELECT review_id, overall, [w FOR w IN words IF w NOT IN {in_list(STOP_WORDS)}] AS words
        FROM tokens""",
}
PLAIN = WORDS | {
    "texts": """SELECT review_id, overall, coalesce(array_to_string(words, ' '), '') AS text
                FROM filtered"""
}


def porter_steps(source: str) -> dict[str, str]:
    """CTEs from `source(word)` to `stems(word, stem)`, one per step of the algorithm."""
    import string

    def keep(column: str, suffix: str) -> str:
        return f"left({column}, length({column}) - {len(suffix)})"

    def table(rules: dict[str, str], condition: str) -> str:
        ordered = sorted(rules, key=len, reverse=True)
        cases = " ".join(
            f"WHEN w LIKE '%{s}' THEN CASE WHEN regexp_matches({keep('w', s)}, '{condition}') "
            f"THEN {keep('w', s)} || '{rules[s]}' ELSE w END"
            for s in ordered
        )
        return f"CASE {cases} ELSE w END"

    past = f"""CASE
        WHEN w LIKE '%eed' THEN CASE WHEN regexp_matches({keep('w', 'eed')}, '{st.MEASURE_ABOVE_0}')
            THEN left(w, length(w) - 1) ELSE w END
        WHEN regexp_matches(w, '[aeiouy].*(ed|ing)$') THEN CASE
            WHEN regexp_matches(b, '{st.UNDOUBLED}') THEN left(b, length(b) - 1)
            WHEN regexp_matches(b, '{st.RESTORES_E}') OR regexp_matches(b, '{st.SHORT_WORD}')
                THEN b || 'e'
            ELSE b END
        ELSE w END"""
    step4 = " ".join(
        f"WHEN w LIKE '%{s}' THEN CASE WHEN regexp_matches({keep('w', s)}, '{st.MEASURE_ABOVE_1}')"
        + (f" AND regexp_matches({keep('w', s)}, '[st]$')" if s == "ion" else "")
        + f" THEN {keep('w', s)} ELSE w END"
        for s in sorted(st.STEP_4, key=len, reverse=True)
    )
    b = keep("w", "e")
    step5a = f"""CASE WHEN w LIKE '%e' AND (regexp_matches({b}, '{st.MEASURE_ABOVE_1}')
        OR (regexp_matches({b}, '{st.MEASURE_ABOVE_0}')
            AND NOT regexp_matches({b}, '{st.SHORT_END}'))) THEN {b} ELSE w END"""
    step5b = f"""CASE WHEN w LIKE '%ll' AND regexp_matches({b}, '{st.MEASURE_ABOVE_1}')
        THEN {b} ELSE w END"""
    expressions = [
        table(st.STEP_1A, ""),
        past,
        "CASE WHEN regexp_matches(w, '[aeiouy].*[yY]$') THEN left(w, length(w) - 1) || 'i' ELSE w END",
        table(st.STEP_2, st.MEASURE_ABOVE_0),
        table(st.STEP_3, st.MEASURE_ABOVE_0),
        f"CASE {step4} ELSE w END",
        step5a,
        step5b,
    ]
    ctes = {
        "step_a": f"""SELECT word, regexp_replace(regexp_replace(word, '^y', 'Y'),
                      '([aeiouy])y', '\\1Y', 'g') AS w FROM (SELECT DISTINCT word FROM {source})"""
    }
    last = "step_a"
    for letter, expression in zip(string.ascii_lowercase[1:], expressions):
        stem = f"SELECT word, w, regexp_replace(w, '(ed|ing)$', '') AS b FROM {last}"
        ctes[f"step_{letter}"] = f"SELECT word, {expression} AS w FROM ({stem})"
        last = f"step_{letter}"
    return ctes | {"stems": f"SELECT word, replace(w, 'Y', 'y') AS stem FROM {last}"}


# Inflections by the stem `b` that is left without -ed or -ing, restated for SQL.
LEMMA_OF_PAST = r"""CASE
    WHEN regexp_matches(word, '^(agr|decr|disagr|fr|guarant|refer)eed$') THEN left(word, -1)
    WHEN word LIKE '%eed' THEN word
    WHEN regexp_matches(word, '^([dltv]|bel|unt)ied$') THEN left(word, -1)
    WHEN regexp_matches(word, '[a-z]ied$') THEN left(word, -3) || 'y'
    WHEN regexp_matches(word, '^([dltv]|bel|underl|unt)ying$') THEN left(word, -4) || 'ie'
    WHEN word IN ('canoeing', 'dyeing', 'eyeing', 'shoeing', 'singeing', 'tingeing')
        THEN left(word, -3)
    WHEN b IN ('frolick', 'mimick', 'panick', 'picnick', 'traffick', 'quizz') THEN left(b, -1)
    WHEN b IN ('add', 'butt', 'ebb', 'egg', 'err', 'putt', 'purr') THEN b
    WHEN regexp_matches(b, '[aeiouy].*(bb|dd|gg|mm|nn|pp|rr|tt)$') THEN left(b, -1)
    WHEN b IN ('appall', 'befall', 'enroll', 'foretell', 'fulfill', 'install', 'misspell',
               'recall', 'refill', 'unroll') THEN b
    WHEN regexp_matches(b, '[aeiouy][^aeiouy]+[aeiouy]+ll$') THEN left(b, -1)
    WHEN b IN ('arrang', 'aveng', 'bing', 'challeng', 'chang', 'cring', 'exchang', 'fring', 'hing',
               'infring', 'loung', 'lung', 'plung', 'rang', 'rearrang', 'reveng', 'spong', 'ach', 'bath',
               'breath', 'cloth', 'hast', 'past', 'sooth', 'tast', 'wast', 'compet', 'complet',
               'creat', 'delet', 'denot', 'devot', 'promot', 'quot', 'recreat', 'excit', 'ignit',
               'incit', 'invit', 'recit', 'unit', 'condon', 'conven', 'interven', 'postpon', 'ador',
               'deplor', 'explor', 'ignor', 'implor', 'restor', 'underscor', 'adher', 'interfer',
               'persever', 'becom', 'consol', 'escap', 'exhal', 'inhal', 'overcom', 'renam',
               'reshap', 'welcom') THEN b || 'e'
    WHEN b IN ('bias', 'canvas', 'collar', 'debut', 'devil', 'focus', 'margin', 'murmur', 'pencil',
               'ruin', 'sugar') THEN b
    WHEN regexp_matches(b, '[^aeo](at|[aiou]d|ed|[iu]r|ar|u[nmt]|ib|ul)$')
      OR regexp_matches(b, '[^aeou]i[nl]$')
      OR regexp_matches(b, '([bcdfgkpstz]l|yz|[aeiouy]z|[cuv]|[dlraeiou]g)$')
      OR regexp_matches(b, '[aeiouy][a-z]*[^s]s$') OR regexp_matches(b, '^[a-z]?[aeiou]s$')
      OR regexp_matches(b, '[^aeiouy][aiou]k$')
      OR regexp_matches(b, '^[^aeiouy]*[aeiouy][^aeiouywx]$') THEN b || 'e'
    ELSE b END"""
LEMMA_OF_PLURAL = r"""CASE
    WHEN regexp_matches(word, '(ss|us|is|ics)$') THEN word
    WHEN regexp_matches(word, '^[a-z]ies$') OR word IN (
        'aunties', 'besties', 'birdies', 'brownies', 'calories', 'collies', 'cookies', 'cuties',
        'foodies', 'freebies', 'genies', 'goalies', 'groupies', 'hippies', 'hoodies', 'junkies',
        'movies', 'newbies', 'pixies', 'prairies', 'rookies', 'selfies', 'smoothies', 'sorties',
        'sweeties', 'talkies', 'techies', 'townies', 'veggies', 'walkies', 'zombies')
        THEN left(word, -1)
    WHEN word LIKE '%ies' THEN left(word, -3) || 'y'
    WHEN regexp_matches(word, '^(buffal|carg|domin|ech|embarg|her|mang|mosquit|potat|tomat|tornad'
                              || '|torped|vet|volcan|zer)oes$') THEN left(word, -2)
    WHEN left(word, -2) IN (
        'alias', 'atlas', 'bias', 'bonus', 'bus', 'campus', 'canvas', 'census', 'chorus', 'circus',
        'focus', 'gas', 'genius', 'iris', 'lens', 'minus', 'plus', 'sinus', 'status', 'surplus',
        'virus') AND word LIKE '%es' THEN left(word, -2)
    WHEN word = 'quizzes' THEN 'quiz'
    WHEN word IN ('aches', 'backaches', 'earaches', 'headaches', 'heartaches', 'stomachaches',
                  'toothaches', 'avalanches', 'caches', 'mustaches', 'niches', 'quiches')
        THEN left(word, -1)
    WHEN regexp_matches(word, '(ch|sh|ss|x|zz)es$') THEN left(word, -2)
    WHEN regexp_matches(word, '[a-z]{3,}men$') THEN left(word, -2) || 'an'
    WHEN regexp_matches(word, '[a-z]{2,}s$') THEN left(word, -1)
    ELSE word END"""

STEMMED = WORDS | {
    "positions": """SELECT review_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos
                    FROM filtered"""
} | porter_steps("positions") | {
    "stemmed": """
        SELECT f.review_id, f.overall, coalesce(s.text, '') AS text
        FROM filtered f LEFT JOIN (
            SELECT review_id, string_agg(stem, ' ' ORDER BY pos) AS text
            FROM positions JOIN stems USING (word) GROUP BY review_id) s USING (review_id)"""
}
LEMMATIZED = REVIEWS | {
    "pieces": f"""
        SELECT review_id, unnest(p) AS word, generate_subscripts(p, 1) AS pos FROM (
            SELECT review_id, regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(
                regexp_replace(replace({LOWER}, '’', ''''), '\\bcan''t\\b', 'can n''t', 'g'),
                '\\bwon''t\\b', 'will n''t', 'g'), '\\bshan''t\\b', 'shall n''t', 'g'),
                'n''t\\b', ' n''t', 'g'),
                '(n''t|''(?:s|m|re|ve|ll|d)\\b|\\p{{L}}+|\\p{{N}}+|[^\\s\\p{{L}}\\p{{N}}])', 1
            ) AS p FROM reviews)""",
    "lemmas": f"""
        SELECT word, CASE
            {" ".join(f"WHEN word = {quoted(f)} THEN {quoted(l)}" for f, l in IRREGULAR_LEMMAS.items())}
            WHEN word LIKE '%s' OR word LIKE '%men' THEN {LEMMA_OF_PLURAL}
            WHEN regexp_matches(word, '[aeiouy].*(ed|ing)$') THEN {LEMMA_OF_PAST}
            ELSE word END AS lemma
        FROM (SELECT word, regexp_replace(word, '(ed|ing)$', '') AS b
              FROM (SELECT DISTINCT word FROM pieces))""",
    "lemmatized": """
        SELECT r.review_id, r.overall, coalesce(s.text, '') AS text
        FROM reviews r LEFT JOIN (
            SELECT review_id, string_agg(lemma, ' ' ORDER BY pos) AS text
            FROM pieces JOIN lemmas USING (word) GROUP BY review_id) s USING (review_id)""",
}

# Word statistics over `train_texts(review_id, sentiment, text)`


def sentiment(source: str) -> str:
    return f"""SELECT review_id, overall, text,
               CASE WHEN overall = 5.0 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS sentiment
               FROM {source}"""


def statistics(source: str) -> dict[str, str]:
    return {
        "train_texts": sentiment(source),
        "counts": """
            SELECT review_id, sentiment, word, count(*) AS n FROM (
                SELECT review_id, sentiment, unnest(string_split(text, ' ')) AS word
                FROM train_texts)
            WHERE word <> '' GROUP BY ALL""",
        "lengths": """SELECT review_id, sentiment, sum(n)::BIGINT AS review_len
                      FROM counts GROUP BY ALL""",
        "tf": """SELECT review_id, sentiment, word, n, review_len, n / review_len AS tf
                 FROM counts JOIN lengths USING (review_id, sentiment)""",
        "frequencies": """
            SELECT word, sum(n)::BIGINT AS frequency, count(*) AS df,
                   count(*) FILTER (sentiment = 'POSITIVE') AS pos_df,
                   count(*) FILTER (sentiment = 'NEGATIVE') AS neg_df
            FROM counts GROUP BY word""",
        "scored": f"""
            SELECT tf.*, df, tf * ln((SELECT count(*) FROM {source}) / df) AS tfidf
            FROM tf JOIN frequencies USING (word)""",
        "ranked": """
            SELECT review_id, sentiment, word, tfidf,
                   row_number() OVER (PARTITION BY review_id, sentiment
                                      ORDER BY round(ln(nullif(tfidf, 0)), 11) DESC NULLS LAST, word) AS rank,
                   count(*) OVER (PARTITION BY review_id, sentiment) AS n_words
            FROM scored""",
        "features": """SELECT review_id, sentiment, word, tfidf, rank
                       FROM ranked WHERE rank <= ceil(0.75 * n_words)""",
        "feature_texts": """
            SELECT review_id, sentiment, string_agg(word, ' ' ORDER BY rank) AS text
            FROM features GROUP BY ALL""",
        "class_stats": """
            SELECT count(DISTINCT review_id) AS reviews,
                   count(DISTINCT review_id) FILTER (sentiment = 'POSITIVE') AS pos_reviews,
                   count(DISTINCT review_id) FILTER (sentiment = 'NEGATIVE') AS neg_reviews,
                   count(*) FILTER (sentiment = 'POSITIVE' AND tfidf > 0) AS pos_words,
                   count(*) FILTER (sentiment = 'NEGATIVE' AND tfidf > 0) AS neg_words
            FROM scored""",
        "averages": """SELECT word, sentiment, avg(tfidf) AS avg_tfidf FROM scored GROUP BY ALL""",
        "top_words": """
            SELECT * FROM (
                SELECT word, sentiment, avg_tfidf, row_number() OVER (
                    PARTITION BY sentiment ORDER BY round(ln(nullif(avg_tfidf, 0)), 11) DESC NULLS LAST, word) AS rank
                FROM averages) WHERE rank <= 10""",
        "model": """
            SELECT word, count(*) FILTER (sentiment = 'POSITIVE') AS pos_count,
                   count(*) FILTER (sentiment = 'NEGATIVE') AS neg_count
            FROM features GROUP BY word""",
        "probabilities": """
            SELECT word, pos_count, neg_count,
                   (pos_count + 1) / (pos_words + (SELECT count(*) FROM model)) AS pos_prob,
                   (neg_count + 1) / (neg_words + (SELECT count(*) FROM model)) AS neg_prob
            FROM model, class_stats""",
    }


ALL_STATS = PLAIN | statistics("texts")

# Balancing, splitting, scoring


def fraction(use: str) -> str:
    hashed = f"md5(concat(review_id::VARCHAR, ':123:{use}'))"
    return f"(concat('0x', substr({hashed}, 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def balanced(source: str) -> dict[str, str]:
    return {
        "classes": f"""SELECT review_id, overall, text FROM {source}
                       WHERE overall IN (1.0, 2.0, 5.0) AND len(string_split(text, ' ')) > 1""",
        "balanced": f"""
            SELECT review_id, overall, text FROM classes
            WHERE overall < 5.0 OR {fraction('balance')} < (
                SELECT least(1.0, count(*) FILTER (overall < 5.0)
                             / nullif(count(*) FILTER (overall = 5.0), 0)) FROM classes)""",
        "train_set": f"SELECT * FROM balanced WHERE {fraction('split')} < 0.8::DOUBLE",
        "test_set": f"SELECT * FROM balanced WHERE NOT {fraction('split')} < 0.8::DOUBLE",
    }


def scoring(weight: int, empty_weight: int) -> dict[str, str]:
    return {
        "test_tokens": """SELECT review_id, unnest(string_split(rtrim(text, ' '), ' ')) AS word
                          FROM test_set""",
        "unseen": """
            SELECT 1.0::DOUBLE / (pos_words + (SELECT count(*) FROM model)) AS pos_unseen,
                   1.0::DOUBLE / (neg_words + (SELECT count(*) FROM model)) AS neg_unseen,
                   ln(pos_reviews / reviews) AS pos_prior, ln(neg_reviews / reviews) AS neg_prior
            FROM class_stats""",
        "scores": f"""
            SELECT review_id,
                   any_value(pos_prior) + sum(weight * ln(coalesce(pos_prob, pos_unseen))) AS pos_ll,
                   any_value(neg_prior) + sum(weight * ln(coalesce(neg_prob, neg_unseen))) AS neg_ll
            FROM (SELECT review_id, word,
                         CASE WHEN word = '' THEN {empty_weight} ELSE {weight} END AS weight
                  FROM test_tokens)
            LEFT JOIN probabilities USING (word), unseen
            GROUP BY review_id""",
        "predictions": """
            SELECT review_id, overall, text,
                   CASE WHEN round(pos_ll - neg_ll, 9) > 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END
                       AS predicted
            FROM test_set JOIN scores USING (review_id)""",
        "confusion": """
            SELECT count(*) FILTER (predicted = 'POSITIVE' AND overall = 5.0) AS tp,
                   count(*) FILTER (predicted = 'POSITIVE' AND overall < 5.0) AS fp,
                   count(*) FILTER (predicted = 'NEGATIVE' AND overall < 5.0) AS tn,
                   count(*) FILTER (predicted = 'NEGATIVE' AND overall = 5.0) AS fn
            FROM predictions""",
        "metrics": """
            SELECT tp, fp, tn, fn,
                   round((tp + tn) / nullif(tp + fp + tn + fn, 0), 6) AS accuracy,
                   round(tp / nullif(tp + fp, 0), 6) AS precision,
                   round(tp / nullif(tp + fn, 0), 6) AS recall,
                   round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1
            FROM confusion""",
    }


SPLIT = PLAIN | balanced("texts")
MODEL = SPLIT | statistics("train_set")
SCORED = MODEL | scoring(2, 1)
SCORED_STANDARD = MODEL | scoring(1, 0)
VARIANT_TEXTS = {
    "plain": (PLAIN, "texts"),
    "stemmed": (STEMMED, "stemmed"),
    "lemmatized": (LEMMATIZED, "lemmatized"),
}


def all_variants(final: str, extra) -> str:
    """The same chain for each variant, united; every chain is its own subquery."""
    parts = []
    for variant, (ctes, source) in VARIANT_TEXTS.items():
        chain = with_ctes(ctes | balanced(source) | extra, final.format(variant=variant))
        parts.append(f"SELECT * FROM ({chain})")
    return "\nUNION ALL\n".join(parts)


def marked() -> str:
    return "concat(review_id::VARCHAR, CASE WHEN sentiment = 'POSITIVE' THEN '+' ELSE '' END)"


def _line_fields() -> str:
    line = """concat_ws(',', review_id::VARCHAR, coalesce(overall::VARCHAR, '0.0'),
        regexp_replace("reviewText", '[\\r\\n]+', ' ', 'g'))"""
    return f"""SELECT f[1] AS review_id, f[2]::DOUBLE AS overall, f[3] AS text FROM (
        SELECT string_split(rtrim({line}, ','), ',') AS f FROM reviews) WHERE len(f) >= 3
        UNION ALL
        SELECT {line}, NULL, 'fields' FROM reviews
        WHERE len(string_split(rtrim({line}, ','), ',')) < 3
        UNION ALL
        SELECT review_id || ',5.0,,', NULL, 'fields' FROM reviews WHERE review_id % 200 = 0
        UNION ALL
        SELECT review_id || ',five,text', NULL, 'rating' FROM reviews WHERE review_id % 200 = 100"""


REPORTS = """
    SELECT 'word_frequency' AS report, 'ALL' AS sentiment, word, sum(n)::DOUBLE AS value
    FROM counts WHERE word <> 'phone' GROUP BY word
    UNION ALL SELECT 'avg_tfidf_by_sentiment', sentiment, word, round(avg_tfidf, 6) FROM averages
    UNION ALL SELECT 'top_words_by_sentiment', sentiment, word, round(avg_tfidf, 6) FROM top_words
    UNION ALL SELECT 'feature_word_frequency', 'ALL', word, count(*)::DOUBLE
    FROM features GROUP BY word"""

LONG_METRICS = "\nUNION ALL\n".join(
    f"SELECT '{m}' AS metric, {m}::DOUBLE AS value FROM metrics"
    for m in ("tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1")
)

DATASETS = "\nUNION ALL\n".join(
    f"""SELECT '{name}_{{variant}}' AS dataset,
               count(*) FILTER (overall < 5.0) AS n_negative,
               count(*) FILTER (overall = 5.0) AS n_positive,
               sum(length(text))::BIGINT AS n_characters,
               sum(('0x' || left(md5(concat_ws(':', overall::INT, text)), 8))::BIGINT)::BIGINT
                   AS checksum
        FROM {source}"""
    for name, source in (("train", "train_set"), ("test", "test_set"), ("final", "balanced"))
)


def top_fraction(group: str, columns: str, order: str) -> str:
    return f"""
        SELECT {columns}, rank FROM (
            SELECT {columns}, row_number() OVER (PARTITION BY {group} ORDER BY {order}) AS rank,
                   count(*) OVER (PARTITION BY {group}) AS n FROM lineitem)
        WHERE rank <= ceil(0.75 * n)"""


LINE_COLUMNS = "l_orderkey, l_linenumber, l_extendedprice"

ORACLE: dict[str, str] = {
    # sources and sinks
    "json_reviews": with_ctes(REVIEWS, "SELECT * FROM reviews"),
    "json_reviews_inferred": with_ctes(
        REVIEWS,
        """SELECT CASE WHEN review_id % 50 <> 0 THEN review_id ELSE 0 END AS review_id,
                  CASE WHEN review_id % 50 <> 0 THEN overall::VARCHAR END AS overall,
                  CASE WHEN review_id % 50 <> 0 THEN "reviewText" END AS "reviewText",
                  CASE WHEN review_id % 50 <> 0 THEN '{"stars":' || review_id % 5 || '}' END AS extra,
                  CASE WHEN review_id % 50 = 0 THEN '[1] ' || review_id END AS rejected
           FROM reviews""",
    ),
    "json_field_types": with_ctes(
        REVIEWS
        | {
            "kinds": """
                SELECT unnest([
                    {'field': 'review_id', 'kind': 'bigint', 'digits': 0, 'there': true},
                    {'field': 'extra', 'kind': 'object', 'digits': 0, 'there': true},
                    {'field': 'reviewText', 'kind': 'string', 'digits': 0,
                     'there': "reviewText" IS NOT NULL},
                    {'field': 'overall', 'kind': CASE WHEN review_id % 3 = 0 THEN 'string' ELSE 'decimal' END,
                     'digits': CASE WHEN review_id % 3 <> 0 THEN 1 ELSE 0 END, 'there': overall IS NOT NULL}
                ], recursive := true) FROM reviews WHERE review_id % 50 <> 0"""
        },
        """SELECT field, kind, max(digits)::INT AS digits, count(*) AS n_rows
           FROM kinds WHERE there GROUP BY field, kind""",
    ),
    "csv_line_breaks": with_ctes(
        REVIEWS,
        """SELECT review_id AS "index", overall,
                  replace(replace(replace(replace(replace(coalesce("reviewText", ''), 'a', chr(10)),
                      'e', chr(13) || chr(10)), 'i', '"'), 'o', chr(92) || 'n'), 'u', chr(92)) AS text
           FROM reviews""",
    ),
    "csv_reviews": with_ctes(PLAIN, 'SELECT review_id AS "index", overall, text FROM texts'),
    "lenient_lines": with_ctes(REVIEWS, _line_fields()),
    "tsv_stage_scan": with_ctes(ALL_STATS, f"SELECT word, {marked()} AS review, n AS count FROM counts"),
    "csv_export": with_ctes(PLAIN, "SELECT overall, text FROM texts"),
    "tsv_export": with_ctes(
        ALL_STATS,
        f"SELECT concat(word, '@', {marked()}) AS word_review, concat(n, '/', review_len) AS tf FROM tf",
    ),
    "overwrite_sink": with_ctes(
        ALL_STATS, "SELECT word, concat(pos_df, '@', neg_df) AS counts FROM frequencies"
    ),
    "merged_export": with_ctes(
        ALL_STATS, f"SELECT {marked()} AS review_id, text FROM feature_texts"
    ),
    "metrics_report": with_ctes(SCORED, LONG_METRICS),
    # projections and filters
    "project_review_columns": with_ctes(REVIEWS, 'SELECT overall, "reviewText" FROM reviews'),
    "rename_columns": with_ctes(PLAIN, "SELECT review_id AS column_1, text AS column_2 FROM texts"),
    "multiword_filter": with_ctes(
        PLAIN, "SELECT * FROM texts WHERE len(string_split(text, ' ')) > 1"
    ),
    "class_filter": with_ctes(REVIEWS, "SELECT * FROM reviews WHERE overall IN (1.0, 2.0, 5.0)"),
    "sentiment_label": with_ctes(
        PLAIN | {"labelled": sentiment("texts")}, "SELECT review_id, overall, sentiment FROM labelled"
    ),
    "nonempty_tokens": with_ctes(
        REVIEWS,
        f"""SELECT review_id, word, count(*) AS n FROM (
                SELECT review_id, unnest(string_split({LOWER}, ' ')) AS word FROM reviews)
            WHERE word <> '' GROUP BY ALL""",
    ),
    "exclude_words": with_ctes(
        ALL_STATS,
        "SELECT word, sum(n)::BIGINT AS frequency FROM counts WHERE word NOT IN ('phone') GROUP BY word",
    ),
    **{
        name: with_ctes(
            ALL_STATS,
            f"""SELECT * FROM counts WHERE word {test} (
                SELECT unnest(string_split_regex(regexp_replace(
                    lower(coalesce(text, '')), '[^a-zA-Z\\s]', '', 'g'), '\\s+')) FROM benchmark)""",
        )
        for name, test in (("exclude_word_table", "NOT IN"), ("only_word_table", "IN"))
    },
    "sentiment_slice": with_ctes(
        ALL_STATS,
        """SELECT word, sentiment, round(avg_tfidf, 6) AS avg_tfidf FROM averages
           WHERE sentiment = 'NEGATIVE'""",
    ),
    "positive_score_filter": with_ctes(
        ALL_STATS, "SELECT review_id, word FROM scored WHERE tfidf > 0"
    ),
    # text functions
    "lowercase_text": with_ctes(REVIEWS, f"SELECT review_id, {LOWER} AS text FROM reviews"),
    "tokenize_strip": with_ctes(
        WORDS,
        """SELECT review_id, word, count(*) AS n FROM (
               SELECT review_id, unnest(words) AS word FROM tokens) GROUP BY ALL""",
    ),
    "tokenize_literal": with_ctes(
        REVIEWS,
        f"""SELECT review_id, coalesce(array_to_string(
                regexp_extract_all({LOWER}, '([^a-zA-Z\\s])', 1), ' '), '') AS tokens FROM reviews""",
    ),
    "remove_stopwords": with_ctes(
        PLAIN,
        """SELECT review_id, len(words)::INTEGER AS n_words, text
           FROM filtered JOIN texts USING (review_id)""",
    ),
    "stem_words": with_ctes(STEMMED, "SELECT review_id, text FROM stemmed"),
    "lemmatize_words": with_ctes(LEMMATIZED, "SELECT review_id, text FROM lemmatized"),
    "join_tokens": with_ctes(
        WORDS, "SELECT review_id, coalesce(array_to_string(words, ' '), '') AS text FROM tokens"
    ),
    "explode_words": with_ctes(
        PLAIN, "SELECT review_id, unnest(string_split(text, ' ')) AS word FROM texts"
    ),
    "token_count": with_ctes(
        PLAIN, "SELECT review_id, len(string_split(text, ' '))::INTEGER AS n_tokens FROM texts"
    ),
    "clean_text": with_ctes(
        PLAIN | STEMMED | LEMMATIZED,
        """SELECT review_id, p.overall, p.text AS "cleaned_reviewText",
                  s.text AS "cleaned_reviewText_stemmed", l.text AS "cleaned_reviewText_lemmatized"
           FROM texts p JOIN stemmed s USING (review_id) JOIN lemmatized l USING (review_id)""",
    ),
    "composite_key": with_ctes(
        ALL_STATS,
        f"""SELECT word, {marked()} AS review, n, concat(word, '@', {marked()}) AS whole_key
            FROM counts""",
    ),
    "trimmed_text": with_ctes(
        REVIEWS, """SELECT review_id, trim("reviewText", ' ') AS text FROM reviews"""
    ),
    # sampling
    "class_counts": with_ctes(
        REVIEWS,
        """SELECT count(*) FILTER (overall IN (1.0, 2.0)) AS n_negative,
                  count(*) FILTER (overall = 5.0) AS n_positive FROM reviews""",
    ),
    "balanced_sample": with_ctes(SPLIT, "SELECT * FROM balanced"),
    "balanced_sample_exact": with_ctes(
        SPLIT,
        """SELECT * FROM classes WHERE overall < 5.0
           UNION ALL
           (SELECT * FROM classes WHERE overall = 5.0
            QUALIFY row_number() OVER (
                ORDER BY md5(concat(review_id::VARCHAR, ':123:balance')), review_id, text
            ) <= (SELECT count(*) FROM classes WHERE overall < 5.0))""",
    ),
    "smallest_per_group": """
        SELECT l_returnflag, l_orderkey, l_linenumber FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_returnflag
            ORDER BY md5(concat(l_orderkey, '-', l_linenumber, ':123')), l_orderkey, l_linenumber
        ) <= floor(count(*) OVER (PARTITION BY l_returnflag)
                   / CASE WHEN l_returnflag = 'N' THEN 10 ELSE 3 END)""",
    "union_classes": with_ctes(
        REVIEWS,
        """SELECT * FROM reviews WHERE overall IN (1.0, 2.0)
           UNION ALL SELECT * FROM reviews WHERE overall = 5.0""",
    ),
    "shuffled_rows": with_ctes(PLAIN, "SELECT * FROM texts"),
    "train_test_split": with_ctes(
        SPLIT,
        """SELECT review_id, overall, 'train' AS part FROM train_set
           UNION ALL SELECT review_id, overall, 'test' FROM test_set""",
    ),
    "index_rows": with_ctes(
        PLAIN, "SELECT count(*) AS n_rows, count(*) AS n_indexes, TRUE AS from_one FROM texts"
    ),
    "index_rows_contiguous": with_ctes(
        PLAIN,
        """SELECT row_number() OVER (ORDER BY md5(concat(review_id, ':123:order')), review_id)
                      AS index, overall, text FROM texts""",
    ),
    # word statistics
    "word_count": with_ctes(ALL_STATS, "SELECT * FROM counts"),
    "review_total": "SELECT count(*) AS n_reviews FROM documents",
    "term_frequency": with_ctes(
        ALL_STATS, "SELECT review_id, sentiment, word, n, review_len, round(tf, 6) AS tf FROM tf"
    ),
    "document_frequency": with_ctes(ALL_STATS, "SELECT * FROM frequencies"),
    "tf_idf": with_ctes(
        ALL_STATS,
        """SELECT review_id, sentiment, word, n, review_len, round(tf, 6) AS tf, df,
                  round(tfidf, 6) AS tfidf FROM scored""",
    ),
    "feature_selection": with_ctes(
        ALL_STATS,
        "SELECT review_id, sentiment, word, round(tfidf, 6) AS tfidf, rank FROM features",
    ),
    "feature_text": with_ctes(ALL_STATS, "SELECT * FROM feature_texts"),
    "class_statistics": with_ctes(ALL_STATS, "SELECT * FROM class_stats"),
    "word_frequency": with_ctes(
        ALL_STATS, "SELECT word, sum(n)::BIGINT AS frequency FROM counts GROUP BY word"
    ),
    "avg_tfidf_by_sentiment": with_ctes(
        ALL_STATS, "SELECT word, sentiment, round(avg_tfidf, 6) AS avg_tfidf FROM averages"
    ),
    "feature_word_frequency": with_ctes(
        ALL_STATS, "SELECT word, count(*) AS frequency FROM features GROUP BY word"
    ),
    # naive Bayes
    "train_word_counts": with_ctes(MODEL, "SELECT * FROM model"),
    "vocabulary_size": with_ctes(MODEL, "SELECT count(*) AS vocabulary FROM model"),
    "class_priors": with_ctes(
        MODEL,
        """SELECT round(pos_reviews / reviews, 6) AS pos_prior,
                  round(neg_reviews / reviews, 6) AS neg_prior FROM class_stats""",
    ),
    "word_probabilities": with_ctes(
        MODEL,
        """SELECT word, pos_count, neg_count, round(pos_prob, 9) AS pos_prob,
                  round(neg_prob, 9) AS neg_prob FROM probabilities""",
    ),
    "score_reviews": with_ctes(
        SCORED,
        "SELECT review_id, round(pos_ll, 6) AS pos_ll, round(neg_ll, 6) AS neg_ll FROM scores",
    ),
    "score_reviews_standard": with_ctes(
        SCORED_STANDARD,
        "SELECT review_id, round(pos_ll, 6) AS pos_ll, round(neg_ll, 6) AS neg_ll FROM scores",
    ),
    "predict_sentiment": with_ctes(SCORED, "SELECT review_id, text, predicted FROM predictions"),
    "confusion_matrix": with_ctes(SCORED, "SELECT * FROM confusion"),
    "classification_metrics": with_ctes(SCORED, "SELECT * FROM metrics"),
    "model_lookup_join": with_ctes(
        SCORED,
        """SELECT review_id, word, count(*) AS n,
                  round(any_value(coalesce(pos_prob, pos_unseen)), 9) AS pos_prob,
                  round(any_value(coalesce(neg_prob, neg_unseen)), 9) AS neg_prob
           FROM test_tokens LEFT JOIN probabilities USING (word), unseen
           WHERE word <> '' GROUP BY review_id, word""",
    ),
    "scalar_stats_join": with_ctes(
        ALL_STATS, "SELECT word, df, (SELECT count(*) FROM documents) AS n_reviews FROM frequencies"
    ),
    # ranking
    "top_fraction_per_group": top_fraction(
        "l_orderkey", LINE_COLUMNS, "l_extendedprice DESC, l_linenumber"
    ),
    "top_fraction_of_large_groups": top_fraction(
        "l_returnflag",
        f"l_returnflag, {LINE_COLUMNS}",
        "l_extendedprice DESC, l_orderkey, l_linenumber",
    ),
    "top_words_by_sentiment": with_ctes(
        ALL_STATS, "SELECT word, sentiment, round(avg_tfidf, 6) AS avg_tfidf, rank FROM top_words"
    ),
    "head_preview": with_ctes(
        ALL_STATS, "SELECT * FROM counts ORDER BY review_id, word LIMIT 10"
    ),
    # whole jobs
    "prepare_datasets": all_variants(DATASETS, {}),
    "train_and_evaluate": with_ctes(SCORED, "SELECT * FROM metrics"),
    "variant_comparison": all_variants(
        "SELECT '{variant}' AS variant, * FROM metrics", statistics("train_set") | scoring(2, 1)
    ),
    "word_reports": with_ctes(MODEL, REPORTS),
}
