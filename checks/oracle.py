"""The registered queries as SQL for DuckDB, written against the given tables only.

Written out on their own: the SQL states each result in the plainest way (global windows,
per-word lambdas, full joins), so it shares no strategy with the Spark code.
"""

from __future__ import annotations

from corpuscope.functions.stopwords import CLOUD_EXTRA, ENGLISH

SPACE = r"\t-\r\x1c-\x20\x{85}\p{Z}"


def rnd(expr: str, digits: int) -> str:
    return f"(round_even(({expr})::DOUBLE * 1e{digits}, 0) / 1e{digits})"


def words(text: str) -> str:
    return f"coalesce(len(regexp_extract_all({text}, '[^{SPACE}]+')), 0)::BIGINT"


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '^[{SPACE}]+|[{SPACE}]+\z', '', 'g')"


def quoted(names) -> str:
    return ", ".join("'" + name.replace("'", "''") + "'" for name in names)


def tokens(text: str, stop_words=ENGLISH, lower: bool = True) -> str:
    source = f"lower({text})" if lower else text
    found = rf"regexp_extract_all({source}, '[\p{{L}}\p{{N}}_]{{2,}}')"
    return f"list_filter({found}, lambda x: x NOT IN ({quoted(stop_words)}))" if stop_words else found


def grams(n: int, t: str = "t") -> str:
    if n == 1:
        return t
    parts = " || ' ' || ".join(f"{t}[i + {k}]" if k else f"{t}[i]" for k in range(n))
    return f"list_transform(range(1, greatest(len({t}) - {n} + 2, 1)), lambda i: {parts})"


def digest(items: str) -> str:
    return f"md5(array_to_string({items}, '|'))"


UNTIDY = """
untidy AS (
  SELECT d.doc_id,
    CASE WHEN l.quality <> 1 AND l.toxic <> 1 THEN NULL
         WHEN l.quality = 1 AND l.toxic = 1 THEN chr(9) || chr(160) || ' '
         ELSE chr(9) || chr(160) || d.text || chr(8195) || chr(28) END AS text,
    CASE WHEN l.quality <> 1 AND l.toxic = 1 THEN NULL
         WHEN d.source = 'src3' THEN '  '
         ELSE ' ' || d.lang || chr(9) END AS lang
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


UNEVEN = """uneven AS (
  SELECT doc_id, lang || '-' || floor(sqrt(substr(source, 4)::INTEGER))::INTEGER AS source FROM documents)"""


def usable(source: str, name: str = "usable") -> str:
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT doc_id, {strip("text")} AS text, {strip("lang")} AS lang FROM {source}
    WHERE text IS NOT NULL AND lang IS NOT NULL)
  WHERE length(text) > 0)"""


def clean_ctes(source: str, dedup: bool, k: int = 50, least: int = 20) -> str:
    first = "row_number() OVER (PARTITION BY text ORDER BY doc_id)" if dedup else "1"
    return f"""{usable(source)},
firsts AS (SELECT *, {first} AS copy FROM usable),
long_enough AS (
  SELECT doc_id, text, lang, {words("text")} AS word_count FROM firsts
  WHERE copy = 1 AND {words("text")} >= {least}),
cleaned AS (
  SELECT doc_id, text, lang, word_count, length(text)::BIGINT AS char_len FROM long_enough
  WHERE lang IN (SELECT lang FROM long_enough GROUP BY lang HAVING count(*) >= {k}))"""


CLEAN = clean_ctes("documents", True)


def frequency(source: str, label: str) -> str:
    return f"""
  SELECT {label}, n, pct, {rnd(f"sum(pct) OVER (ORDER BY n DESC, {label} ROWS UNBOUNDED PRECEDING)", 2)} AS cumulative_pct
  FROM (SELECT {label}, n, {rnd("n::DOUBLE / sum(n) OVER () * 100.0", 2)} AS pct
        FROM (SELECT {label}, count(*) AS n FROM {source} WHERE {label} IS NOT NULL GROUP BY {label}))"""


PRICES = "prices AS (SELECT l_returnflag, l_extendedprice * (1 - l_discount) AS net FROM lineitem)"

STATS = f"""
  {words("text")} AS word_count,
  coalesce(length(text), 0)::BIGINT AS char_len,
  coalesce(len(list_filter(regexp_split_to_array(text, '[.!?]+'),
                           lambda x: regexp_matches(x, '[^{SPACE}]'))), 0)::BIGINT AS sentence_count,
  coalesce({rnd(f"list_avg(list_transform(regexp_extract_all(text, '[^{SPACE}]+'), lambda x: length(x)))", 2)}, 0.0)
    AS avg_word_len"""

MEASURED = f"measured AS (SELECT doc_id, lang, {STATS} FROM documents)"

GROUPS = "len(regexp_extract_all(lower(x), '[aeiouy]+'))"


def scored(source: str) -> str:
    return f"""
word_lists AS (
  SELECT doc_id, lang, text, regexp_extract_all(text, '[^{SPACE}]+') AS ws,
    greatest(len(list_filter(regexp_split_to_array(text, '[.!?]+'),
                             lambda x: regexp_matches(x, '[^{SPACE}]'))), 1)::DOUBLE AS s
  FROM {source}),
syllable_lists AS (
  SELECT *, list_transform(ws, lambda x: greatest({GROUPS}, 1)) AS sy,
    length(regexp_replace(text, '[^\\p{{L}}\\p{{Nd}}]', '', 'g'))::DOUBLE AS l
  FROM word_lists),
parts AS (
  SELECT doc_id, lang, s, l, len(ws)::DOUBLE AS w, list_sum(sy)::DOUBLE AS y,
    len(list_filter(sy, lambda x: x >= 3))::DOUBLE AS c
  FROM syllable_lists),
scored AS (
  SELECT doc_id, lang,
    CASE WHEN w >= 10 THEN {rnd("206.835::DOUBLE - 1.015::DOUBLE * (w / s) - 84.6::DOUBLE * (y / w)", 2)} END AS flesch_reading_ease,
    CASE WHEN w >= 10 THEN {rnd("0.39::DOUBLE * (w / s) + 11.8::DOUBLE * (y / w) - 15.59::DOUBLE", 2)} END AS flesch_kincaid_grade,
    CASE WHEN w >= 10 THEN {rnd("0.4::DOUBLE * ((w / s) + 100.0::DOUBLE * (c / w))", 2)} END AS gunning_fog,
    CASE WHEN w >= 10 THEN {rnd("0.0588::DOUBLE * (100.0::DOUBLE * l / w) - 0.296::DOUBLE * (100.0::DOUBLE * s / w) - 15.8::DOUBLE", 2)} END AS coleman_liau
  FROM parts)"""


def described(source: str, metrics, digits: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, count({m}) AS count, {rnd(f"avg({m})", digits)} AS mean,
  {rnd(f"stddev_samp({m})", digits)} AS std, {rnd(f"min({m})", digits)} AS min,
  {rnd(f"quantile_cont({m}::DOUBLE, 0.25)", digits)} AS q25, {rnd(f"quantile_cont({m}::DOUBLE, 0.5)", digits)} AS q50,
  {rnd(f"quantile_cont({m}::DOUBLE, 0.75)", digits)} AS q75, {rnd(f"max({m})", digits)} AS max FROM {source}"""
        for m in metrics
    )


def stats_ctes(source: str, gram: str, by: str = "", stop_words=ENGLISH) -> str:
    comma = f"{by}, " if by else ""
    return f"""
tok AS (SELECT doc_id, {comma}{tokens("coalesce(text, '')", stop_words)} AS t FROM {source}),
occ AS (SELECT doc_id, {comma}unnest({gram}) AS term FROM tok),
stats AS (SELECT {comma}term, count(DISTINCT doc_id) AS df, count(*) AS total FROM occ GROUP BY {comma}term)"""


FOLDED = f"""
raw AS (SELECT doc_id, lang, {tokens("coalesce(text, '')", ())} AS t FROM documents),
occ AS (SELECT lang, unnest(t) AS term FROM raw),
written AS (SELECT lang, term, count(*) AS total FROM occ WHERE term NOT IN ({quoted((*ENGLISH, *CLOUD_EXTRA))}) GROUP BY lang, term),
forms AS (
  SELECT w.lang, w.term, coalesce(s.term, w.term) AS form FROM written w
  LEFT JOIN written s ON s.lang = w.lang AND regexp_matches(w.term, '[^s]s$') AND s.term = w.term[:-2]),
words AS (SELECT lang, form AS term, sum(total)::BIGINT AS total FROM written JOIN forms USING (lang, term) GROUP BY lang, form)"""


def clouded(source: str, top: int) -> str:
    return f"""SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY total DESC, term) AS rank, term, total,
  {rnd("total / (max(total) OVER (PARTITION BY lang))::DOUBLE", 8)} AS weight
FROM {source} WHERE lang IN ({largest("lang", 6)})
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY total DESC, term) <= {top}"""


def vocab_ctes(source: str, gram: str, where: str = "true", top: int = 10_000) -> str:
    return f"""{stats_ctes(source, gram)},
n_docs AS (SELECT count(*)::DOUBLE AS n FROM {source}),
vocab AS (
  SELECT term, df, total, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf
  FROM stats, n_docs WHERE {where} ORDER BY total DESC, term LIMIT {top})"""


TERM_BOUNDS = "df >= 3 AND df <= 0.85::DOUBLE * n"
VOCAB = vocab_ctes("documents", "t", TERM_BOUNDS)
WEIGHTS = """
tf AS (SELECT doc_id, term, count(*) AS tf FROM occ GROUP BY doc_id, term),
raw AS (SELECT doc_id, term, tf, tf * idf AS x FROM tf JOIN vocab USING (term)),
weights AS (SELECT doc_id, term, tf, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""
TOP_TERMS = f"""{VOCAB},{WEIGHTS},
sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
means AS (
  SELECT lang, term, {rnd("sum(weight) / any_value(sizes.n)", 10)} AS score
  FROM weights JOIN documents USING (doc_id) JOIN sizes USING (lang) GROUP BY lang, term),
best AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, term) AS rank, term,
    {rnd("score", 4)} AS tfidf_score
  FROM means QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, term) <= 15)"""


def largest(label: str, top: int) -> str:
    return f"SELECT {label} FROM documents GROUP BY {label} ORDER BY count(*) DESC, {label} LIMIT {top}"


def label_vocab(label: str) -> str:
    return f"""
tok AS (SELECT doc_id, {label} AS label, {tokens("text")} AS t FROM documents WHERE {label} IN ({largest(label, 10)})),
occ AS (SELECT doc_id, label, unnest(t) AS term FROM tok),
lv AS (SELECT label, term, count(DISTINCT doc_id) AS df FROM occ GROUP BY label, term HAVING count(DISTINCT doc_id) >= 3)"""


def split_ctes(source: str, label: str, test: float = 0.15, val: float = 0.15, seed: int = 42) -> str:
    fraction = f"({val}::DOUBLE / (1.0::DOUBLE - {test}::DOUBLE))"
    rest = "floor((e - floor(e)) * 1e9 + 0.5)"
    val_total = f"ceil({fraction} * pool_total)" if val else "0"
    return f"""
c AS (SELECT {label} AS label, count(*) AS n FROM {source} GROUP BY {label}),
t1 AS (SELECT *, sum(n) OVER () AS total FROM c),
t2 AS (SELECT *, total - ceil({test}::DOUBLE * total) AS pool_total FROM t1),
e1 AS (SELECT *, n / total::DOUBLE * pool_total AS e FROM t2),
r1 AS (SELECT *, row_number() OVER (ORDER BY {rest} DESC, label) AS pos, pool_total - sum(floor(e)) OVER () AS missing FROM e1),
p AS (SELECT label, n, pool_total, floor(e) + CASE WHEN pos <= missing THEN 1 ELSE 0 END AS pool FROM r1),
e2 AS (SELECT *, pool_total - {val_total} AS train_total, pool / pool_total * (pool_total - {val_total}) AS e FROM p),
r2 AS (SELECT *, row_number() OVER (ORDER BY {rest} DESC, label) AS pos, train_total - sum(floor(e)) OVER () AS missing FROM e2),
quotas AS (
  SELECT label, n, (n - pool)::BIGINT AS n_test, (pool - tr)::BIGINT AS n_val, tr::BIGINT AS n_train
  FROM (SELECT *, floor(e) + CASE WHEN pos <= missing THEN 1 ELSE 0 END AS tr FROM r2)),
placed AS (
  SELECT s.*, row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}:' || doc_id::VARCHAR), doc_id) AS place
  FROM {source} s),
assigned AS (
  SELECT placed.*, CASE WHEN place <= n_test THEN 'test' WHEN place <= n_test + n_val THEN 'val' ELSE 'train' END AS split
  FROM placed JOIN quotas ON placed.{label} = quotas.label)"""


READY = f"{CLEAN},{split_ctes('cleaned', 'lang')}"

GUESSED = """
guessed AS (
  SELECT lang AS label, CASE WHEN length(text) < 300 THEN 'unknown'
    WHEN regexp_matches(lower(text), '[ñ¿]|ción') THEN 'es'
    WHEN regexp_matches(lower(text), '[ßüöä]') THEN 'de'
    WHEN regexp_matches(lower(text), '[èêç]') THEN 'fr' ELSE 'en' END AS prediction
  FROM documents),
names AS (SELECT label FROM guessed UNION SELECT prediction FROM guessed),
tallies AS (
  SELECT label,
    (SELECT count(*) FROM guessed g WHERE g.label = names.label) AS support,
    (SELECT count(*) FROM guessed g WHERE g.prediction = names.label) AS predicted,
    (SELECT count(*) FROM guessed g WHERE g.label = names.label AND g.prediction = names.label) AS hits
  FROM names),
pr AS (
  SELECT label, support, hits,
    CASE WHEN predicted > 0 THEN hits / predicted::DOUBLE ELSE 0 END AS p,
    CASE WHEN support > 0 THEN hits / support::DOUBLE ELSE 0 END AS r
  FROM tallies),
scores AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM pr)"""

OUTLIER_BOUNDS = f"""{MEASURED},
q AS (SELECT quantile_cont(word_count::DOUBLE, 0.25) AS q1, quantile_cont(word_count::DOUBLE, 0.75) AS q3 FROM measured),
b AS (SELECT q1, q3, q1 - 1.5::DOUBLE * (q3 - q1) AS lower_bound, q3 + 1.5::DOUBLE * (q3 - q1) AS upper_bound FROM q)"""


def histogram(metric: str) -> str:
    return f"""
  SELECT '{metric}' AS metric, bin, {rnd("lo + (bin - 1) * (hi - lo) / 50.0::DOUBLE", 6)} AS bin_low,
    {rnd("lo + bin * (hi - lo) / 50.0::DOUBLE", 6)} AS bin_high,
    (SELECT count(*) FROM measured
     WHERE least(50, floor(({metric} - lo) * 50.0::DOUBLE / (hi - lo)) + 1) = bin)::BIGINT AS n
  FROM (SELECT min({metric})::DOUBLE AS lo, max({metric})::DOUBLE AS hi FROM measured), (SELECT unnest(range(1, 51)) AS bin)"""


ORACLE: dict[str, str] = {
    "parquet_scan": "SELECT doc_id, text, lang FROM documents",
    "renamed_columns": "SELECT doc_id::VARCHAR AS doc_id, lang AS label, n_chars FROM documents",
    "strip_text": f"WITH {UNTIDY} SELECT doc_id, {strip('text')} AS text, {strip('lang')} AS lang FROM untidy",
    "text_stats": f"WITH {UNTIDY} SELECT doc_id, {STATS} FROM untidy",
    "fill_missing": f"""WITH {UNTIDY}
SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS char_len FROM untidy""",
    "tokens": f"""SELECT doc_id, len(t) AS n_tokens, {digest("t")} AS tokens
FROM (SELECT doc_id, {tokens("text", ())} AS t FROM documents)""",
    "stop_word_removal": f"""SELECT doc_id, len(t) AS n_tokens, {digest("t")} AS tokens
FROM (SELECT doc_id, {tokens("text")} AS t FROM documents)""",
    "ngram_lists": f"""SELECT doc_id, {digest("t")} AS unigrams, {digest(grams(2))} AS bigrams,
  {digest(grams(3))} AS trigrams, {digest(f"list_concat(t, {grams(2)})")} AS uni_bigrams
FROM (SELECT doc_id, {tokens("text")} AS t FROM documents)""",
    "preprocessing_options": f"""SELECT doc_id, {digest(tokens("text", (), False))} AS cased,
  {digest(tokens("text", ()))} AS lowered, {digest(tokens("text"))} AS without_stop_words,
  least(len({tokens("text")}), 512) AS n_within_max_length FROM documents""",
    "drop_missing": f"WITH {UNTIDY} SELECT doc_id, lang FROM untidy WHERE text IS NOT NULL AND lang IS NOT NULL",
    "drop_empty": f"""WITH {UNTIDY}
SELECT doc_id, {strip("lang")} AS lang FROM untidy WHERE {strip("text")} <> '' AND {strip("lang")} <> ''""",
    "usable_rows": f"WITH {UNTIDY},{usable('untidy')} SELECT * FROM usable",
    "min_words": f"SELECT doc_id, lang, n_chars FROM documents WHERE {words('text')} >= 20",
    "rare_label_filter": f"""WITH {UNEVEN} SELECT doc_id, source FROM uneven
WHERE source IN (SELECT source FROM uneven GROUP BY source HAVING count(*) >= 20)""",
    "top_label_rows": f"""WITH {UNEVEN} SELECT doc_id, source FROM uneven WHERE source IN (
  SELECT source FROM uneven GROUP BY source ORDER BY count(*) DESC, source LIMIT 10)""",
    "outlier_rows": f"""WITH {OUTLIER_BOUNDS}
SELECT doc_id, lang, word_count FROM measured, b WHERE word_count < lower_bound OR word_count > upper_bound""",
    "exact_dedup": """SELECT doc_id, text, lang FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    "clean_pair": f"WITH {UNTIDY},{clean_ctes('untidy', False)} SELECT doc_id, text, lang FROM cleaned",
    "clean_pair_as_named": f"""WITH {UNTIDY},{clean_ctes('untidy', False, 80, 30)}
SELECT doc_id, text, lang FROM cleaned""",
    "clean_distinct": f"WITH {CLEAN} SELECT * FROM cleaned",
    "clean_distinct_untidy": f"WITH {UNTIDY},{clean_ctes('untidy', True)} SELECT * FROM cleaned",
    "clean_summary": f"""WITH {CLEAN} SELECT count(*) AS n_rows, count(DISTINCT lang) AS n_labels,
  min(word_count) AS min_word_count, max(word_count) AS max_word_count FROM cleaned""",
    "clean_preview": f"WITH {CLEAN} SELECT * FROM cleaned ORDER BY lang, word_count DESC, doc_id LIMIT 10",
    "missing_profile": f"""WITH {UNTIDY}, m AS (
  SELECT 'doc_id' AS column_name, count(*) - count(doc_id) AS missing_count, count(*) AS n FROM untidy
  UNION ALL SELECT 'text', count(*) - count(text), count(*) FROM untidy
  UNION ALL SELECT 'lang', count(*) - count(lang), count(*) FROM untidy)
SELECT column_name, missing_count, {rnd("missing_count / n::DOUBLE * 100.0", 2)} AS missing_pct FROM m WHERE missing_count > 0""",
    "duplicate_profile": f"""WITH {UNTIDY}, copies AS (
  SELECT row_number() OVER (PARTITION BY text ORDER BY doc_id) AS copy FROM untidy)
SELECT count(*) AS n_rows, count(*) FILTER (copy > 1) AS duplicate_rows,
  {rnd("count(*) FILTER (copy > 1) / count(*)::DOUBLE * 100.0", 1)} AS duplicate_pct FROM copies""",
    "table_shape": """SELECT count(*) AS n_rows, 5::BIGINT AS n_columns,
  'doc_id,text,lang,source,n_chars' AS column_names FROM documents""",
    "label_frequency": f"WITH {UNTIDY} {frequency('untidy', 'lang')}",
    "clean_label_frequency": f"WITH {CLEAN} {frequency('cleaned', 'lang')}",
    "pareto": f"""WITH {UNEVEN} SELECT source, n, position, {rnd("share", 8)} AS cumulative_pct, share >= 80 AS reaches_cut FROM (
  SELECT source, n, row_number() OVER (ORDER BY n DESC, source) AS position,
    sum(n) OVER (ORDER BY n DESC, source ROWS UNBOUNDED PRECEDING) / (sum(n) OVER ())::DOUBLE * 100.0 AS share
  FROM (SELECT source, count(*) AS n FROM uneven GROUP BY source))""",
    "imbalance": f"""WITH {UNTIDY},
c AS (SELECT lang, count(*) AS n FROM untidy WHERE lang IS NOT NULL GROUP BY lang),
o AS (SELECT *, row_number() OVER (ORDER BY n DESC, lang) AS pos, count(*) OVER () AS k, sum(n) OVER () AS total FROM c),
top AS (SELECT * FROM o WHERE pos = 1), low AS (SELECT * FROM o WHERE pos = k)
SELECT top.k AS n_classes, top.lang AS majority_label, top.n AS majority_n,
  {rnd("top.n / top.total::DOUBLE * 100.0", 2)} AS majority_pct, low.lang AS minority_label, low.n AS minority_n,
  {rnd("low.n / low.total::DOUBLE * 100.0", 2)} AS minority_pct, {rnd("top.n / low.n::DOUBLE", 8)} AS imbalance_ratio,
  {rnd("(SELECT count(*) FROM untidy) / top.k::DOUBLE", 8)} AS rows_per_class,
  CASE WHEN top.n < 5 * low.n THEN 'low' WHEN top.n <= 20 * low.n THEN 'medium' ELSE 'high' END AS band
FROM top, low""",
    "thin_labels": f"WITH {UNEVEN} SELECT source, count(*) AS n FROM uneven GROUP BY source HAVING count(*) < 50",
    "thin_label_totals": f"""WITH {UNEVEN} SELECT count(*) FILTER (n < 50) AS labels_below_50, count(*) FILTER (n < 100) AS labels_below_100
FROM (SELECT source, count(*) AS n FROM uneven GROUP BY source)""",
    "top_share": f"""WITH {UNEVEN} SELECT {rnd("sum(pct)", 2)} AS top_share_pct FROM (
  SELECT pct FROM ({frequency("uneven", "source")}) ORDER BY n DESC, source LIMIT 5)""",
    "top_labels": f"WITH {UNEVEN} SELECT source, count(*) AS n FROM uneven GROUP BY source ORDER BY n DESC, source LIMIT 6",
    "distinct_labels": f"WITH {UNTIDY} SELECT count(DISTINCT lang) AS n_labels FROM untidy",
    "describe_lengths": f"""WITH {MEASURED}
{described("measured", ("word_count", "char_len", "sentence_count", "avg_word_len"), 1)}""",
    "median_words_by_label": f"""WITH {MEASURED}
SELECT lang, quantile_cont(word_count::DOUBLE, 0.5) AS median_word_count FROM measured GROUP BY lang""",
    "iqr_bounds": f"WITH {OUTLIER_BOUNDS} SELECT * FROM b",
    "outlier_summary": f"""WITH {OUTLIER_BOUNDS}, o AS (
  SELECT any_value(q1) AS q1, any_value(q3) AS q3, any_value(lower_bound) AS lower_bound,
    any_value(upper_bound) AS upper_bound, count(*) AS n_rows,
    count(*) FILTER (word_count < lower_bound) AS short, count(*) FILTER (word_count > upper_bound) AS long
  FROM measured, b)
SELECT q1, q3, lower_bound, upper_bound, n_rows, short + long AS outliers,
  {rnd("(short + long) / n_rows::DOUBLE * 100.0", 1)} AS outlier_pct, short, long FROM o""",
    "length_histogram": f"""WITH {MEASURED}
{histogram("word_count")} UNION ALL {histogram("char_len")} UNION ALL {histogram("sentence_count")}""",
    "box_summary": f"""WITH {MEASURED},
q AS (
  SELECT lang, quantile_cont(word_count::DOUBLE, 0.25) AS q1, quantile_cont(word_count::DOUBLE, 0.5) AS median,
    quantile_cont(word_count::DOUBLE, 0.75) AS q3 FROM measured GROUP BY lang),
m AS (SELECT *, word_count BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM measured JOIN q USING (lang))
SELECT lang, q1, median, q3, count(*) AS n_rows,
  least(min(word_count::DOUBLE) FILTER (inside), q1) AS whisker_low,
  greatest(max(word_count::DOUBLE) FILTER (inside), q3) AS whisker_high,
  count(*) FILTER (NOT inside) AS outliers
FROM m GROUP BY lang, q1, median, q3""",
    "describe_prices": f"""WITH {PRICES}
SELECT l_returnflag, 'net' AS metric, count(net) AS count, {rnd("avg(net)", 3)} AS mean, {rnd("stddev_samp(net)", 3)} AS std,
  {rnd("min(net)", 3)} AS min, {", ".join(f"{rnd(f'quantile_cont(net, {q / 100})', 3)} AS q{q}" for q in (25, 50, 75))},
  {rnd("max(net)", 3)} AS max FROM prices GROUP BY l_returnflag""",
    "price_bounds": f"""WITH {PRICES},
q AS (SELECT l_returnflag, quantile_cont(net, 0.25) AS a, quantile_cont(net, 0.75) AS b FROM prices GROUP BY l_returnflag)
SELECT l_returnflag, {rnd("a", 6)} AS q1, {rnd("b", 6)} AS q3, {rnd("a - 1.5 * (b - a)", 6)} AS lower_bound,
  {rnd("b + 1.5 * (b - a)", 6)} AS upper_bound FROM q""",
    "price_outliers": f"""WITH {PRICES},
q AS (SELECT quantile_cont(net * net, 0.25) AS a, quantile_cont(net * net, 0.75) AS b FROM prices)
SELECT l_returnflag, count(*) AS n FROM prices, q
WHERE net * net < a - 1.5 * (b - a) OR net * net > b + 1.5 * (b - a) GROUP BY l_returnflag""",
    "part_frequency": frequency("lineitem", "l_partkey"),
    "part_pareto": f"""SELECT l_partkey, n, position, {rnd("share", 8)} AS cumulative_pct, share >= 80 AS reaches_cut FROM (
  SELECT l_partkey, n, row_number() OVER (ORDER BY n DESC, l_partkey) AS position,
    sum(n) OVER (ORDER BY n DESC, l_partkey ROWS UNBOUNDED PRECEDING) / (sum(n) OVER ())::DOUBLE * 100.0 AS share
  FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey))""",
    "part_weights": f"""SELECT l_partkey, n, {rnd("sum(n) OVER () / (count(*) OVER () * n)::DOUBLE", 8)} AS weight
FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey)""",
    "part_quotas": f"""WITH {split_ctes("(SELECT *, l_orderkey * 8 + l_linenumber AS doc_id FROM lineitem)", "l_partkey")}
SELECT label AS l_partkey, n, n_test, n_val, n_train FROM quotas""",
    "readability": f"WITH {scored('documents')} SELECT * EXCLUDE (lang) FROM scored",
    "describe_readability": f"""WITH {scored('documents')}
{described("scored", ("flesch_reading_ease", "flesch_kincaid_grade", "gunning_fog", "coleman_liau"), 2)}""",
    "readability_by_label": f"""WITH {scored('documents')} SELECT lang,
  {", ".join(f"{rnd(f'quantile_cont({m}, 0.5)', 6)} AS median_{m}" for m in ("flesch_reading_ease", "flesch_kincaid_grade", "gunning_fog"))}
FROM scored GROUP BY lang""",
    "corpus_summary": f"""WITH {UNTIDY}, present AS (SELECT * FROM untidy WHERE text IS NOT NULL),{scored("present")},
m AS (SELECT {STATS} FROM present),
freq AS ({frequency("present", "lang")}),
b AS (SELECT count(*) AS n_labels, {rnd("max(n) / min(n)::DOUBLE", 1)} AS imbalance_ratio,
  count(*) FILTER (n < 50) AS labels_below_50, count(*) FILTER (n < 100) AS labels_below_100 FROM freq)
SELECT (SELECT count(*) FROM present) AS n_rows, b.*,
  (SELECT {rnd("sum(pct)", 1)} FROM (SELECT pct FROM freq ORDER BY n DESC, lang LIMIT 5)) AS top5_pct,
  (SELECT {rnd("quantile_cont(word_count::DOUBLE, 0.5)", 4)} FROM m) AS median_words,
  (SELECT {rnd("avg(word_count)", 4)} FROM m) AS mean_words,
  (SELECT {rnd("stddev_samp(word_count)", 4)} FROM m) AS std_words,
  (SELECT {rnd("quantile_cont(flesch_kincaid_grade, 0.5)", 4)} FROM scored) AS median_fk_grade
FROM b""",
    "document_terms": f"""WITH {stats_ctes("documents", "t")}
SELECT doc_id, term, count(*) AS tf FROM occ GROUP BY doc_id, term""",
    "vocabulary": f"WITH {VOCAB} SELECT term, df, total, {rnd('idf', 8)} AS idf FROM vocab",
    "tfidf_weights": f"WITH {VOCAB},{WEIGHTS} SELECT doc_id, term, tf, {rnd('weight', 8)} AS weight FROM weights",
    "tfidf_top_terms": f"WITH {TOP_TERMS} SELECT * FROM best",
    "tfidf_heatmap": f"""WITH {TOP_TERMS} SELECT term,
  {", ".join(f"coalesce(max(tfidf_score) FILTER (lang = '{name}'), 0.0) AS {name}" for name in ("de", "en", "es", "fr"))}
FROM best WHERE rank <= 10 GROUP BY term""",
    "sublinear_tfidf": f"""WITH {READY},
train AS (SELECT * FROM assigned WHERE split = 'train'),
{vocab_ctes("train", f"list_concat(t, {grams(2)})", top=20_000)},
htok AS (SELECT doc_id, {tokens("text")} AS t FROM assigned),
hocc AS (SELECT doc_id, unnest(list_concat(t, {grams(2)})) AS term FROM htok),
htf AS (SELECT doc_id, term, count(*) AS tf FROM hocc GROUP BY doc_id, term),
raw AS (SELECT doc_id, term, tf, (1.0::DOUBLE + ln(tf)) * idf AS x FROM htf JOIN vocab USING (term))
SELECT doc_id, term, tf, {rnd("x / sqrt(sum(x * x) OVER (PARTITION BY doc_id))", 8)} AS weight FROM raw""",
    **{
        f"top_{name}": f"""WITH {stats_ctes("documents", grams(n))}
SELECT term, total FROM stats
WHERE df >= 2 AND df <= 0.9::DOUBLE * (SELECT count(*) FROM documents) ORDER BY total DESC, term LIMIT 20"""
        for name, n in (("bigrams", 2), ("trigrams", 3))
    },
    "bigrams_by_label": f"""WITH chosen AS (
  SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, lang LIMIT 5),
{stats_ctes("documents", grams(2), "lang")}
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY total DESC, term) AS rank, term, total
FROM stats JOIN chosen USING (lang) WHERE df >= 2 AND df <= 0.9::DOUBLE * n
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY total DESC, term) <= 10""",
    "label_vocabularies": f"WITH {label_vocab('lang')} SELECT label AS lang, term, df FROM lv",
    "vocabulary_union": f"WITH {label_vocab('lang')} SELECT DISTINCT term FROM lv",
    "label_sets": f"""WITH {label_vocab('source')}, s AS (
  SELECT term, string_agg(label, ',' ORDER BY label) AS labels FROM lv GROUP BY term)
SELECT labels, count(*) AS n FROM s GROUP BY labels""",
    "jaccard": f"""WITH {label_vocab('source')}, top AS ({largest('source', 10)}),
p AS (SELECT a.source AS label_a, b.source AS label_b FROM top a, top b),
sz AS (SELECT label, count(*) AS n FROM lv GROUP BY label),
sh AS (SELECT x.label AS label_a, y.label AS label_b, count(*) AS n FROM lv x JOIN lv y USING (term) GROUP BY ALL),
u AS (
  SELECT p.label_a, p.label_b, coalesce(sh.n, 0) AS n_shared,
    coalesce(a.n, 0) + coalesce(b.n, 0) - coalesce(sh.n, 0) AS n_union
  FROM p LEFT JOIN sh ON p.label_a = sh.label_a AND p.label_b = sh.label_b
  LEFT JOIN sz a ON a.label = p.label_a LEFT JOIN sz b ON b.label = p.label_b)
SELECT *, CASE WHEN n_union > 0 THEN {rnd("n_shared / n_union::DOUBLE", 3)} ELSE 0.0 END AS jaccard FROM u""",
    "exclusive_terms": f"""WITH {label_vocab('lang')},
k AS (SELECT term, count(*) AS k FROM lv GROUP BY term),
s AS (SELECT label, count(*) AS n, count(*) FILTER (k = 1) AS u FROM lv JOIN k USING (term) GROUP BY label)
SELECT lang, coalesce(n, 0) AS n_terms, coalesce(u, 0) AS n_unique, coalesce({rnd("u / n::DOUBLE * 100.0", 1)}, 0.0) AS unique_pct,
  (SELECT count(*) FROM k) AS n_all FROM ({largest('lang', 10)}) LEFT JOIN s ON s.label = lang""",
    "cloud_weights": f"""WITH
{stats_ctes("documents", "t", "lang", (*ENGLISH, *CLOUD_EXTRA))}
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY total DESC, term) AS rank, term, total,
  {rnd("total / (max(total) OVER (PARTITION BY lang))::DOUBLE", 8)} AS weight
FROM stats WHERE lang IN ({largest("lang", 6)})
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY total DESC, term) <= 80""",
    "cloud_plurals": f"""WITH {FOLDED} {clouded("words", 2000)}""",
    "cloud_phrases": f"""WITH {FOLDED},
place AS (SELECT doc_id, lang, unnest(t) AS term, unnest(range(len(t))) AS p FROM raw),
pair AS (
  SELECT a.lang, f.form AS first, g.form AS second, count(*) AS seen FROM place a JOIN place b ON a.doc_id = b.doc_id AND b.p = a.p + 1
  JOIN forms f ON f.lang = a.lang AND f.term = a.term JOIN forms g ON g.lang = b.lang AND g.term = b.term GROUP BY ALL),
sized AS (
  SELECT pair.*, x.total::DOUBLE AS c1, y.total::DOUBLE AS c2, (SELECT sum(total) FROM words w WHERE w.lang = pair.lang)::DOUBLE AS n
  FROM pair JOIN words x ON x.lang = pair.lang AND x.term = first JOIN words y ON y.lang = pair.lang AND y.term = second),
phrase AS (
  SELECT * FROM sized WHERE n > c1 AND n > c2 AND 2 * (
    ln(greatest(seen / c1, 1e-10)) * seen + ln(greatest(1 - seen / c1, 1e-10)) * (c1 - seen)
    + ln(greatest((c2 - seen) / (n - c1), 1e-10)) * (c2 - seen) + ln(greatest(1 - (c2 - seen) / (n - c1), 1e-10)) * (n - c1 - c2 + seen)
    - ln(greatest(c2 / n, 1e-10)) * c2 - ln(greatest(1 - c2 / n, 1e-10)) * (n - c2)) > 30),
lost AS (
  SELECT lang, term, sum(seen) AS lost FROM (
    SELECT lang, first AS term, seen FROM phrase UNION ALL SELECT lang, second, seen FROM phrase) GROUP BY lang, term),
cloud AS (
  SELECT lang, term, (total - coalesce(lost, 0))::BIGINT AS total FROM words LEFT JOIN lost USING (lang, term) WHERE total > coalesce(lost, 0)
  UNION ALL SELECT lang, first || ' ' || second, seen::BIGINT FROM phrase)
{clouded("cloud", 80)}""",
    "vocabulary_lookup": f"""WITH {VOCAB} SELECT doc_id, count(*) AS n_known, count(DISTINCT term) AS n_distinct_known
FROM occ WHERE term IN (SELECT term FROM vocab) GROUP BY doc_id""",
    "split_quotas": f"""WITH {split_ctes("documents", "source")}
SELECT label AS source, n, n_test, n_val, n_train FROM quotas""",
    "split_assignment": f"WITH {split_ctes('documents', 'lang')} SELECT doc_id, lang, split FROM assigned",
    "split_without_validation": f"""WITH {split_ctes("documents", "source", 0.2, 0, 7)}
SELECT doc_id, source, split FROM assigned""",
    "train_ready": f"""WITH {READY}
SELECT doc_id, text, lang AS label, split, word_count, char_len FROM assigned""",
    "split_label_counts": f"""WITH {READY} SELECT split, lang AS label, count(*) AS n_rows FROM assigned
GROUP BY split, lang ORDER BY split, n_rows DESC, label LIMIT 15""",
    "split_summary": f"""WITH {READY} SELECT count(*) AS n_rows, count(DISTINCT lang) AS n_labels,
  {", ".join(f"count(*) FILTER (split = '{s}') AS {s}_rows" for s in ("train", "val", "test"))} FROM assigned""",
    "split_rows": f"WITH {split_ctes('documents', 'lang')} SELECT doc_id, lang, split AS part FROM assigned",
    "train_ready_preview": f"""WITH {READY} SELECT doc_id, lang AS label, split, word_count, char_len FROM assigned
ORDER BY CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END, lang, word_count, doc_id LIMIT 10""",
    "class_weights": f"""SELECT lang, n, {rnd("sum(n) OVER () / (count(*) OVER () * n)::DOUBLE", 8)} AS weight
FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)""",
    "baseline_optimum": f"""WITH {READY}
SELECT lang AS label, n, {rnd("sum(n) OVER () / (count(*) OVER () * n)::DOUBLE", 8)} AS weight, 0.0::DOUBLE AS steepest
FROM (SELECT lang, count(*) AS n FROM assigned WHERE split = 'train' GROUP BY lang)""",
    "marked_predictions": f"""WITH {READY}
SELECT doc_id, lang AS label, split, lang AS prediction FROM assigned WHERE split <> 'train'""",
    "marked_report": f"""WITH {READY}, v AS (SELECT lang, count(*) AS n FROM assigned WHERE split = 'val' GROUP BY lang)
SELECT lang AS label, 1.0::DOUBLE AS "precision", 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, n AS support FROM v
UNION ALL SELECT 'accuracy', NULL, NULL, 1.0, sum(n)::BIGINT FROM v
UNION ALL SELECT name, 1.0, 1.0, 1.0, sum(n)::BIGINT FROM v, (VALUES ('macro avg'), ('weighted avg')) AS t(name) GROUP BY name""",
    "refused_inputs": """SELECT * FROM (VALUES
  ('columns', 'Dataset missing required columns: [''label'', ''split'']'),
  ('columns present', ''),
  ('no training rows', 'shares test=0.5, val=0.5 leave 0.0 for training; test and training need some'),
  ('no test rows', 'shares test=0.0, val=0.2 leave 0.8 for training; test and training need some'),
  ('sizes taken', ''),
  ('single rows', 'a label has a single row where two sides need one each'),
  ('empty side', 'the val side has no rows'),
  ('one label', 'The classifier needs at least two labels.')
) AS t("case", message)""",
    "confusion": f"""WITH {GUESSED} SELECT label AS truth, prediction, count(*) AS n FROM guessed GROUP BY label, prediction""",
    "classification_report": f"""WITH {GUESSED}
SELECT label, {rnd("p", 8)} AS "precision", {rnd("r", 8)} AS recall, {rnd("f", 8)} AS f1, support FROM scores
UNION ALL SELECT 'accuracy', NULL, NULL, {rnd("sum(hits) / sum(support)::DOUBLE", 8)}, sum(support)::BIGINT FROM scores
UNION ALL SELECT 'macro avg', {rnd("avg(p)", 8)}, {rnd("avg(r)", 8)}, {rnd("avg(f)", 8)}, sum(support)::BIGINT FROM scores
UNION ALL SELECT 'weighted avg', {rnd("sum(p * support) / sum(support)", 8)}, {rnd("sum(r * support) / sum(support)", 8)},
  {rnd("sum(f * support) / sum(support)", 8)}, sum(support)::BIGINT FROM scores""",
    "macro_f1": f"WITH {GUESSED} SELECT {rnd('avg(f)', 8)} AS macro_f1 FROM scores",
    "metrics_record": f"""WITH {GUESSED} SELECT {rnd("avg(f)", 8)} AS macro_f1,
  (SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM guessed) AS labels,
  (SELECT count(*) FROM guessed) AS validation_rows FROM scores""",
    "one_csv_file": """SELECT doc_id, source AS description, md5(text) AS text_md5, NULL::VARCHAR AS sample_name,
  '6" of "' || lang AS keywords, lang AS medical_specialty FROM documents""",
    "prepared_splits": f"""WITH {clean_ctes("documents", False)},{split_ctes("cleaned", "lang")}
SELECT text, lang, split FROM assigned""",
}

ORACLE["linear_scores"] = f"""WITH {READY},
train AS (SELECT * FROM assigned WHERE split = 'train'),
{vocab_ctes("train", f"list_concat(t, {grams(2)})", top=5000)},
htok AS (SELECT doc_id, {tokens("text")} AS t FROM assigned),
hocc AS (SELECT doc_id, unnest(list_concat(t, {grams(2)})) AS term FROM htok),
htf AS (SELECT doc_id, term, count(*) AS tf FROM hocc GROUP BY doc_id, term),
raw AS (SELECT doc_id, term, (1.0::DOUBLE + ln(tf)) * idf AS x FROM htf JOIN vocab USING (term)),
m AS (SELECT doc_id, {", ".join(f"sum(x * ((length(term) * {i + 2} % 7) - 3) * 0.1) / sqrt(sum(x * x)) AS m{i}" for i in range(3))}
  FROM raw GROUP BY doc_id)
SELECT doc_id, lang AS label, {", ".join(rnd(f"coalesce(m{i}, 0) - 0.3::DOUBLE", 7) + f" AS margin_{i}" for i in range(3))}
FROM assigned LEFT JOIN m USING (doc_id)"""
ORACLE |= {
    "stored_clean": ORACLE["clean_distinct"], "stored_train_ready": ORACLE["train_ready"], "stored_metrics": ORACLE["metrics_record"],
    "splits_from_csv": ORACLE["prepared_splits"], "profile_top_terms": ORACLE["tfidf_top_terms"],
    "profile_exclusive_terms": ORACLE["exclusive_terms"], "profile_cloud_weights": ORACLE["cloud_weights"],
}

ORACLE["term_dictionary"] = f"""WITH {stats_ctes("documents", "t")}
SELECT term, row_number() OVER (ORDER BY term) AS id FROM (SELECT DISTINCT term FROM occ)"""
for encoded, words in {
    "top_terms": "tfidf_top_terms", "trigrams": "top_trigrams", "bigrams_by_label": "bigrams_by_label",
    "label_vocabularies": "label_vocabularies", "cloud_weights": "cloud_weights", "sublinear_tfidf": "sublinear_tfidf",
}.items():
    ORACLE[f"encoded_{encoded}"] = ORACLE[words]
