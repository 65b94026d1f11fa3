"""The registered queries in SQL, put together from common table expressions."""

from catalog import tables as t
from textlens.functions.constants import (
    DEFAULT_QUERIES,
    ENGLISH_STOP_WORDS,
    NA_STRINGS,
    NEGATIVE_PLACEHOLDERS,
    POSITIVE_PLACEHOLDERS,
)
from textlens.functions.text import WHITESPACE
from textlens.operators.tfidf import TfidfSettings

SEED = 42


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def literals(values) -> str:
    return ", ".join(literal(v) for v in values)


def with_ctes(ctes: list[str], final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


def strip(c: str) -> str:
    return rf"regexp_replace(regexp_replace({c}, '\A{WHITESPACE}+', ''), '{WHITESPACE}+\z', '')"


def normalize(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WHITESPACE}+', ' ', 'g'))"


def clean(c: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({c}, '')), '[^a-z]+', ' ', 'g'))"


def blanked(c: str, phrases) -> str:
    value = strip(f"coalesce({c}, '')")
    return f"CASE WHEN lower({value}) IN ({literals(phrases)}) THEN '' ELSE {value} END"


FIRST_LINE = "split_part(d.text, chr(10), 1)"
RAW = f"""raw AS (
  SELECT d.doc_id, d.source AS Hotel_Name, d.lang,
    CASE WHEN d.doc_id % 7 = 0 THEN 'No Positive' ELSE {FIRST_LINE} END AS Positive_Review,
    CASE WHEN contains(d.text, chr(10)) THEN substr(d.text, length({FIRST_LINE}) + 2)
      ELSE 'No Negative' END AS Negative_Review,
    CASE WHEN d.doc_id % 50 = 0 THEN 'n/a'
      WHEN l.quality = 1 THEN CASE WHEN d.doc_id % 2 = 0 THEN '9.6' ELSE '8.0' END
      WHEN l.quality = 0 THEN CASE WHEN d.doc_id % 2 = 0 THEN '3.3' ELSE '5.0' END
      ELSE '6.5' END AS Reviewer_Score
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
BLANKED = f"""blanked AS (
  SELECT doc_id, Hotel_Name, lang, Reviewer_Score, try_cast(Reviewer_Score AS DOUBLE) AS score,
    {blanked("Positive_Review", POSITIVE_PLACEHOLDERS)} AS Positive_Review,
    {blanked("Negative_Review", NEGATIVE_PLACEHOLDERS)} AS Negative_Review
  FROM raw)"""
TEXTS = f"""texts AS (
  SELECT *, {normalize("Positive_Review || ' ' || Negative_Review")} AS review_text,
    {normalize("Negative_Review")} AS negative_text, {normalize("Positive_Review")} AS positive_text,
    CASE WHEN score <= 5 THEN 'negative' WHEN score >= 8 THEN 'positive' END AS binary_label
  FROM blanked)"""
REVIEWS = [RAW, BLANKED, TEXTS]


def docs_cte(column: str = "review_text", name: str = "docs") -> str:
    return f"""{name} AS (
  SELECT * FROM (SELECT *, {clean(column)} AS clean_text FROM texts) WHERE clean_text <> '')"""


DOCS = [*REVIEWS, docs_cte()]
COMPLAINTS = [*REVIEWS, docs_cte("negative_text")]


def words(c: str = "clean_text", stop_words=ENGLISH_STOP_WORDS) -> str:
    stops = f" AND NOT list_contains([{literals(stop_words)}], w)" if stop_words else ""
    return f"list_filter(string_split({c}, ' '), lambda w: length(w) >= 2{stops})"


def terms(settings) -> str:
    if not settings.bigrams:
        return "words"
    return "list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))"


def counts_cte(name: str, docs: str, settings) -> str:
    """(doc_id, term, tf)"""
    return f"""{name} AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest({terms(settings)}) AS term FROM (SELECT doc_id, {words()} AS words FROM {docs}))
  GROUP BY doc_id, term)"""


def vocabulary_ctes(docs: str, settings) -> list[str]:
    """counts(doc_id, term, tf) and vocab(term_id, term, df, ctf, idf) of ``docs``"""
    return [
        counts_cte("counts", docs, settings),
        f"total AS (SELECT count(*) AS n FROM {docs})",
        f"""chosen AS (
  SELECT term, count(*) AS df, sum(tf)::BIGINT AS ctf FROM counts GROUP BY term
  HAVING count(*) >= {settings.min_df} AND count(*) <= {settings.max_df}::DOUBLE * (SELECT n FROM total)
  ORDER BY ctf DESC, term LIMIT {settings.max_features})""",
        """vocab AS (
  SELECT row_number() OVER (ORDER BY term) - 1 AS term_id, term, df, ctf,
    ln((1.0::DOUBLE + (SELECT n FROM total)) / (1.0::DOUBLE + df)) + 1 AS idf FROM chosen)""",
    ]


def weights_cte(name: str, counts: str) -> str:
    """(doc_id, term_id, term, weight) of the counted documents by ``vocab``"""
    return f"""{name} AS (
  SELECT doc_id, term_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight
  FROM (SELECT doc_id, term_id, term, tf * idf AS w FROM {counts} JOIN vocab USING (term)))"""


def tfidf_ctes(docs: str, settings) -> list[str]:
    return [*vocabulary_ctes(docs, settings), weights_cte("weights", "counts")]


# Sampling and splitting


def keyed(columns: str, source: str) -> str:
    return f"SELECT {columns}, md5(concat_ws(':', doc_id, {SEED})) AS k FROM {source}"


def split_ctes(source: str, label: str) -> list[str]:
    """parts(doc_id, label, clean_text, is_test): exact class shares, left-over rows by remainder"""
    return [
        f"labelled AS ({keyed(f'doc_id, {label} AS label, clean_text', source)} WHERE {label} IS NOT NULL)",
        "class_n AS (SELECT label, count(*) AS c FROM labelled GROUP BY label)",
        """all_n AS (
  SELECT sum(c)::BIGINT AS n, sum(c)::BIGINT - ceil(0.2::DOUBLE * sum(c))::BIGINT AS n_train FROM class_n)""",
        """shares AS (
  SELECT label, c, n_train, (n_train * c) // n AS floor_train, (n_train * c) % n AS remainder
  FROM class_n, all_n)""",
        """quotas AS (
  SELECT label, c - floor_train - CASE WHEN row_number() OVER (ORDER BY remainder DESC, label)
    <= n_train - sum(floor_train) OVER () THEN 1 ELSE 0 END AS n_test FROM shares)""",
        """parts AS (
  SELECT doc_id, label, clean_text,
    row_number() OVER (PARTITION BY label ORDER BY k) <= n_test AS is_test
  FROM labelled JOIN quotas USING (label))""",
    ]


LABEL = {"binary": "binary_label", "three_class": "coalesce(binary_label, 'neutral')"}


# Classification


def train_ctes(scheme: str = "binary", settings: TfidfSettings = t.LEARN) -> list[str]:
    """weights (train) and test_weights (test) with the vocabulary of the training part"""
    return [
        *DOCS,
        *split_ctes("docs", LABEL[scheme]),
        "train AS (SELECT * FROM parts WHERE NOT is_test)",
        "test AS (SELECT * FROM parts WHERE is_test)",
        *tfidf_ctes("train", settings),
        counts_cte("test_counts", "test", settings),
        weights_cte("test_weights", "test_counts"),
        "train_n AS (SELECT label, count(*) AS c FROM train GROUP BY label)",
        """cells AS (
  SELECT n.label, v.term, coalesce(s.o, 0) AS o FROM train_n n CROSS JOIN vocab v
  LEFT JOIN (SELECT label, term, sum(weight) AS o FROM weights JOIN train USING (doc_id)
             GROUP BY label, term) s ON s.label = n.label AND s.term = v.term)""",
    ]


def chi2_ctes() -> list[str]:
    return [
        """chi2s AS (
  SELECT term, sum((o - e) * (o - e) / e) AS chi2 FROM (
    SELECT term, o, sum(o) OVER (PARTITION BY term) * c / (SELECT sum(c) FROM train_n)::DOUBLE AS e
    FROM cells JOIN train_n USING (label))
  GROUP BY term)"""
    ]


def bayes_ctes(k: int = 0, tag: str = "") -> list[str]:
    """predictions<tag>(doc_id, label, prediction, target_score) on the k best terms (0: all)"""
    kept = "SELECT term FROM chi2s"
    if k:
        kept += f" ORDER BY round(chi2, 6) DESC, term DESC LIMIT {k}"
    return [
        f"kept{tag} AS ({kept})",
        f"""likelihood{tag} AS (
  SELECT label, term, ln(o + 1) - ln(sum(o + 1) OVER (PARTITION BY label)) AS ll
  FROM cells WHERE term IN (SELECT term FROM kept{tag}))""",
        f"""scores{tag} AS (
  SELECT x.doc_id, x.label AS true_label, n.label AS label,
    coalesce(sum(w.weight * l.ll), 0) + ln(any_value(n.c) / (SELECT sum(c) FROM train_n)::DOUBLE) AS s
  FROM test x CROSS JOIN train_n n
  LEFT JOIN test_weights w ON w.doc_id = x.doc_id
  LEFT JOIN likelihood{tag} l ON l.term = w.term AND l.label = n.label
  GROUP BY x.doc_id, x.label, n.label)""",
        f"""predictions{tag} AS (
  SELECT doc_id, true_label AS label, arg_max(label, s ORDER BY label) AS prediction,
    1 / sum(exp(s - neg)) AS target_score
  FROM (SELECT *, max(CASE WHEN label = 'negative' THEN s END) OVER (PARTITION BY doc_id) AS neg
        FROM scores{tag})
  GROUP BY doc_id, true_label)""",
    ]


def learned(k: int = 0, scheme: str = "binary") -> list[str]:
    return [*train_ctes(scheme), *chi2_ctes(), *bayes_ctes(k)]


def report_ctes(tag: str = "") -> list[str]:
    """confusion, per_class and overall of predictions<tag>"""
    return [
        f"""seen{tag} AS (
  SELECT label FROM predictions{tag} UNION SELECT prediction FROM predictions{tag})""",
        f"""confusion{tag} AS (
  SELECT a.label AS true_label, b.label AS predicted_label, count(p.doc_id) AS count
  FROM seen{tag} a CROSS JOIN seen{tag} b
  LEFT JOIN predictions{tag} p ON p.label = a.label AND p.prediction = b.label GROUP BY a.label, b.label)""",
        f"""sides{tag} AS (
  SELECT s.label, sum(CASE WHEN true_label = s.label THEN count ELSE 0 END)::BIGINT AS support,
    sum(CASE WHEN predicted_label = s.label THEN count ELSE 0 END)::BIGINT AS predicted,
    sum(CASE WHEN true_label = s.label AND predicted_label = s.label THEN count ELSE 0 END)::BIGINT AS hits
  FROM seen{tag} s CROSS JOIN confusion{tag} GROUP BY s.label)""",
        f"""per_class{tag} AS (
  SELECT label, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall,
    CASE WHEN predicted + support > 0 THEN 2 * hits / (predicted + support) ELSE 0 END AS f1, support
  FROM sides{tag})""",
        f"""overall{tag} AS (
  SELECT avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1,
    sum(precision * support) / sum(support) AS weighted_precision,
    sum(recall * support) / sum(support) AS weighted_recall,
    sum(f1 * support) / sum(support) AS weighted_f1,
    sum(recall * support) / sum(support) AS accuracy, sum(support)::BIGINT AS support
  FROM per_class{tag})""",
    ]


METRICS = ("macro_precision", "macro_recall", "macro_f1", "weighted_f1", "accuracy")


def rounded(columns) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def curve_ctes(tag: str = "") -> list[str]:
    """steps: running counts per distinct rounded score, highest first"""
    return [
        f"""per_score{tag} AS (
  SELECT round(target_score, 6) AS score, count(*) FILTER (label = 'negative') AS hits,
    count(*) FILTER (label <> 'negative') AS misses FROM predictions{tag} GROUP BY 1)""",
        f"""steps{tag} AS (
  SELECT *, sum(hits) OVER (ORDER BY score DESC) AS tp, sum(misses) OVER (ORDER BY score DESC) AS fp,
    row_number() OVER (ORDER BY score DESC) AS step, count(*) OVER () AS n_steps,
    sum(hits) OVER () AS positives, sum(misses) OVER () AS negatives,
    lead(hits) OVER (ORDER BY score DESC) AS next_hits,
    lead(misses) OVER (ORDER BY score DESC) AS next_misses FROM per_score{tag})""",
    ]


def curve_row(model: str, tag: str) -> str:
    return f"""SELECT '{model}' AS model,
  round(sum(hits / positives * tp / (tp + fp)), 6) AS average_precision_negative,
  round(sum(misses / negatives * (2 * tp - hits) / (2 * positives)), 6) AS roc_auc_negative,
  round(sum(hits) / sum(hits + misses), 6) AS negative_prevalence FROM steps{tag}"""


BOTH = [
    *train_ctes(), *chi2_ctes(), *bayes_ctes(0, "_all"), *bayes_ctes(t.FEW, "_sel"),
]
SWEEP = [*train_ctes(settings=t.PAIRS), *chi2_ctes()] + [
    c for k in t.SWEEP for c in (*bayes_ctes(k, f"_{k}"), *report_ctes(f"_{k}"))
]
SWEEP_ROWS = " UNION ALL ".join(
    f"SELECT {k} AS feature_selection_k, 'naive_bayes' AS model, {', '.join(METRICS)} FROM overall_{k}"
    for k in t.SWEEP
)
RATIO = """ratio AS (
  SELECT term, round(max(CASE WHEN label = 'positive' THEN ll END) - max(CASE WHEN label = 'negative' THEN ll END), 6)
    AS weight FROM likelihood GROUP BY term)"""
HIGHEST = "row_number() OVER (ORDER BY weight DESC, term)"
LOWEST = "row_number() OVER (ORDER BY weight, term)"
SENTIMENT_TERMS = f"""sentiment_terms AS (
  SELECT 'positive' AS sentiment, {HIGHEST} AS rank, term FROM ratio QUALIFY rank <= 20
  UNION ALL SELECT 'negative' AS sentiment, {LOWEST} AS rank, term FROM ratio QUALIFY rank <= 15)"""


# Clusters

# One more cluster than there are languages, so that an empty one shows.
LANGUAGES = """languages AS (
  SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS cluster FROM documents WHERE lang IS NOT NULL GROUP BY lang)"""
CLUSTER = [
    *COMPLAINTS,
    *tfidf_ctes("docs", t.COMPLAINTS),
    LANGUAGES,
    """lang_n AS (
  SELECT lang, cluster, count(*) AS c FROM docs JOIN languages USING (lang) GROUP BY lang, cluster)""",
    """centers AS (
  SELECT n.cluster, w.term, sum(w.weight) / any_value(n.c) AS value
  FROM weights w JOIN docs d USING (doc_id) JOIN lang_n n USING (lang) GROUP BY n.cluster, w.term)""",
    "center_norms AS (SELECT cluster, sum(value * value) AS nc FROM centers GROUP BY cluster)",
    "row_norms AS (SELECT doc_id, sum(weight * weight) AS nx FROM weights GROUP BY doc_id)",
    """dots AS (
  SELECT doc_id, cluster, sum(weight * value) AS dot FROM weights JOIN centers USING (term)
  GROUP BY doc_id, cluster)""",
    """distances AS (
  SELECT d.doc_id, c.cluster,
    sqrt(greatest(coalesce(r.nx, 0) + c.nc - 2 * coalesce(p.dot, 0), 0)) AS distance
  FROM docs d CROSS JOIN center_norms c LEFT JOIN row_norms r ON r.doc_id = d.doc_id
  LEFT JOIN dots p ON p.doc_id = d.doc_id AND p.cluster = c.cluster)""",
    """assigned AS (
  SELECT doc_id, cluster, distance FROM distances
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY distance, cluster) = 1)""",
    f"""sizes AS (
  SELECT i.cluster, count(a.doc_id) AS size FROM (SELECT cluster FROM languages UNION ALL SELECT count(*) FROM languages) i
  LEFT JOIN assigned a USING (cluster) GROUP BY i.cluster)""",
    """cluster_terms AS (
  SELECT cluster, term, sum(weight) / any_value(size) AS weight,
    row_number() OVER (PARTITION BY cluster ORDER BY round(sum(weight) / any_value(size), 6) DESC, term) AS rank
  FROM weights JOIN assigned USING (doc_id) JOIN sizes USING (cluster) GROUP BY cluster, term
  QUALIFY rank <= 12)""",
    """nearest AS (
  SELECT cluster, row_number() OVER (PARTITION BY cluster ORDER BY round(distance, 6), doc_id) AS rank,
    doc_id, distance FROM assigned QUALIFY rank <= 3)""",
]
MOVED = """moved AS (
  SELECT cluster, term, sum(weight) / any_value(size) AS value FROM weights JOIN assigned USING (doc_id) JOIN sizes USING (cluster)
  GROUP BY cluster, term)"""
# Distances to the moved centers; a center without rows stays.
AGAIN = [
    """present AS (
  SELECT * FROM moved UNION ALL SELECT cluster, term, value FROM centers WHERE cluster NOT IN (SELECT cluster FROM assigned))""",
    "present_norms AS (SELECT cluster, sum(value * value) AS nc FROM present GROUP BY cluster)",
    """present_dots AS (
  SELECT doc_id, cluster, sum(weight * value) AS dot FROM weights JOIN present USING (term) GROUP BY doc_id, cluster)""",
    """assigned_again AS (
  SELECT d.doc_id, c.cluster,
    sqrt(greatest(coalesce(r.nx, 0) + c.nc - 2 * coalesce(p.dot, 0), 0)) AS distance
  FROM docs d CROSS JOIN present_norms c LEFT JOIN row_norms r ON r.doc_id = d.doc_id
  LEFT JOIN present_dots p ON p.doc_id = d.doc_id AND p.cluster = c.cluster
  QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY distance, c.cluster) = 1)""",
]
SILHOUETTE = [
    *CLUSTER,
    f"picked AS ({keyed('doc_id, cluster', 'assigned')} ORDER BY k LIMIT 5000)",
    """pairs AS (
  SELECT a.doc_id, b.doc_id AS other_id, sum(a.weight * b.weight) AS dot
  FROM weights a JOIN weights b USING (term)
  WHERE a.doc_id IN (SELECT doc_id FROM picked) AND b.doc_id IN (SELECT doc_id FROM picked)
  GROUP BY a.doc_id, b.doc_id)""",
    """apart AS (
  SELECT x.doc_id, x.cluster, y.cluster AS other,
    sum(sqrt(greatest(coalesce(rx.nx, 0) + coalesce(ry.nx, 0) - 2 * coalesce(p.dot, 0), 0))) AS total,
    count(*) AS size
  FROM picked x CROSS JOIN picked y
  LEFT JOIN row_norms rx ON rx.doc_id = x.doc_id LEFT JOIN row_norms ry ON ry.doc_id = y.doc_id
  LEFT JOIN pairs p ON p.doc_id = x.doc_id AND p.other_id = y.doc_id
  GROUP BY x.doc_id, x.cluster, y.cluster)""",
    """sides AS (
  SELECT doc_id, cluster, max(CASE WHEN other = cluster THEN size END) AS own,
    max(CASE WHEN other = cluster AND size > 1 THEN total / (size - 1) END) AS a,
    min(CASE WHEN other <> cluster THEN total / size END) AS b FROM apart GROUP BY doc_id, cluster)""",
    """silhouettes AS (
  SELECT doc_id, cluster,
    coalesce(CASE WHEN own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) END, 0) AS silhouette
  FROM sides)""",
]
SUMMARY_COLUMNS = """'cluster_' || s.cluster AS cluster_id, s.size,
  coalesce((SELECT string_agg(term, ', ' ORDER BY rank) FROM cluster_terms c WHERE c.cluster = s.cluster), '')
    AS top_terms"""


# Search


def asked_ctes(queries: str) -> list[str]:
    """asked: weights of (query_id, query) rows by ``vocab``"""
    return [
        f"queries AS ({queries})",
        f"asked_docs AS (SELECT query_id AS doc_id, {clean('query')} AS clean_text FROM queries)",
        counts_cte("asked_counts", "asked_docs", t.SEARCH),
        weights_cte("asked", "asked_counts"),
        """scored AS (
  SELECT q.query_id, q.query, d.doc_id, coalesce(h.score, 0) AS score
  FROM queries q CROSS JOIN (SELECT doc_id FROM docs) d
  LEFT JOIN (SELECT a.doc_id AS query_id, w.doc_id, sum(a.weight * w.weight) AS score
             FROM asked a JOIN weights w USING (term) GROUP BY a.doc_id, w.doc_id) h
    ON h.query_id = q.query_id AND h.doc_id = d.doc_id)""",
    ]


def found_cte(top_k: int) -> str:
    return f"""found AS (
  SELECT query_id, query, doc_id, score,
    row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank
  FROM scored QUALIFY rank <= {top_k})"""


FROM_BENCHMARK = "SELECT item_id AS query_id, text AS query FROM benchmark"
FROM_DEFAULTS = " UNION ALL ".join(
    f"SELECT {i} AS query_id, {literal(q)} AS query" for i, q in enumerate(DEFAULT_QUERIES, start=1)
)
SEARCH = [*DOCS, *tfidf_ctes("docs", t.SEARCH)]
SEARCH_BENCHMARK = [*SEARCH, *asked_ctes(FROM_BENCHMARK), found_cte(5)]


def excerpt(c: str, limit: int = 220) -> str:
    return f"CASE WHEN length({c}) <= {limit} THEN {c} ELSE substr({c}, 1, {limit - 3}) || '...' END"


def funnel(text: str, labelled: str) -> str:
    letters = f"{clean(text)} <> ''"
    counts = f"""SELECT count(*) AS rows_loaded, count(*) FILTER ({labelled}) AS rows_after_labeling,
  count(*) FILTER ({labelled} AND {text} <> '') AS rows_after_text_filter,
  count(*) FILTER ({labelled} AND {text} <> '' AND {letters}) AS rows_after_cleaning FROM texts"""
    return with_ctes(
        REVIEWS,
        f"""SELECT *, rows_loaded - rows_after_labeling AS dropped_by_label,
  rows_after_labeling - rows_after_text_filter AS dropped_by_empty_text,
  rows_after_text_filter - rows_after_cleaning AS dropped_by_empty_clean_text FROM ({counts})""",
    )


VOCABULARY_COLUMNS = "term_id, term, df, ctf, round(idf, 6) AS idf"
PREDICTION_COLUMNS = "doc_id, label, prediction, round(target_score, 6) AS target_score"

ORACLE = {
    "missing_values": with_ctes(
        [RAW],
        f"""SELECT doc_id, score_text, coalesce(score_text, '') AS filled FROM (SELECT doc_id,
  CASE WHEN Reviewer_Score NOT IN ({literals(NA_STRINGS)}) THEN Reviewer_Score END AS score_text FROM raw)""",
    ),
    "score_histogram": with_ctes(
        [RAW],
        """SELECT try_cast(Reviewer_Score AS DOUBLE) AS reviewer_score, count(*) AS count FROM raw
WHERE try_cast(Reviewer_Score AS DOUBLE) IS NOT NULL GROUP BY 1""",
    ),
    "normalized_text": f"SELECT doc_id, {normalize('text')} AS normalized FROM documents",
    "cleaned_text": f"SELECT doc_id, {clean('text')} AS clean_text FROM documents",
    "blanked_placeholders": with_ctes(
        [RAW, BLANKED], "SELECT doc_id, Positive_Review, Negative_Review FROM blanked"
    ),
    "text_columns": with_ctes(REVIEWS, "SELECT doc_id, review_text, negative_text, positive_text FROM texts"),
    "numeric_scores": with_ctes([RAW, BLANKED], "SELECT doc_id, score FROM blanked"),
    "binary_sentiment": with_ctes(
        REVIEWS, "SELECT doc_id, binary_label AS label FROM texts WHERE binary_label IS NOT NULL"
    ),
    "three_class_sentiment": with_ctes(
        REVIEWS, "SELECT doc_id, coalesce(binary_label, 'neutral') AS label FROM texts"
    ),
    "nonempty_complaints": with_ctes(
        REVIEWS, "SELECT doc_id, negative_text FROM texts WHERE negative_text <> ''"
    ),
    "cleaned_complaints": with_ctes(COMPLAINTS, "SELECT doc_id, clean_text FROM docs"),
    "cleaned_praise": with_ctes(
        [*REVIEWS, docs_cte("positive_text")], "SELECT doc_id, clean_text FROM docs"
    ),
    "text_excerpts": with_ctes(REVIEWS, f"SELECT doc_id, {excerpt('review_text')} AS text_excerpt FROM texts"),
    "display_columns": with_ctes(
        DOCS,
        f"""SELECT doc_id, coalesce(Hotel_Name, '') AS hotel_name, score AS reviewer_score,
  {excerpt('review_text')} AS text_excerpt FROM docs""",
    ),
    "binary_row_funnel": funnel("review_text", "binary_label IS NOT NULL"),
    "complaint_row_funnel": funnel("negative_text", "true"),
    "seeded_sample": f"""SELECT doc_id, lang FROM ({keyed('doc_id, lang', 'documents')})
ORDER BY k LIMIT {t.SAMPLE_SIZE}""",
    "stratified_parts": with_ctes(
        [*DOCS, *split_ctes("docs", LABEL["binary"])], "SELECT doc_id, label, is_test FROM parts"
    ),
    "three_class_part_sizes": with_ctes(
        [*DOCS, *split_ctes("docs", LABEL["three_class"])],
        "SELECT label, is_test, count(*) AS rows FROM parts GROUP BY label, is_test",
    ),
    "text_words": with_ctes(
        DOCS, f"SELECT doc_id, array_to_string({words(stop_words=())}, ' ') AS words FROM docs"
    ),
    "content_words": with_ctes(DOCS, f"SELECT doc_id, array_to_string({words()}, ' ') AS words FROM docs"),
    "words_and_pairs": with_ctes(
        DOCS,
        f"""SELECT doc_id, array_to_string({terms(t.SEARCH_BIGRAMS)}, '|') AS terms
FROM (SELECT doc_id, {words()} AS words FROM docs)""",
    ),
    "document_term_counts": with_ctes([*DOCS, counts_cte("counts", "docs", t.SEARCH)], "SELECT * FROM counts"),
    "corpus_term_counts": with_ctes(
        [*DOCS, counts_cte("counts", "docs", t.SEARCH)],
        """SELECT term, count(*) AS df, sum(tf)::BIGINT AS ctf FROM counts GROUP BY term
UNION ALL SELECT NULL, count(*), 0 FROM docs""",
    ),
    "vocabulary": with_ctes(
        [*DOCS, *vocabulary_ctes("docs", t.SEARCH)], f"SELECT {VOCABULARY_COLUMNS} FROM vocab"
    ),
    "vocabulary_with_pairs": with_ctes(
        [*DOCS, *vocabulary_ctes("docs", t.SEARCH_BIGRAMS)], f"SELECT {VOCABULARY_COLUMNS} FROM vocab"
    ),
    "capped_vocabulary": with_ctes(
        [*DOCS, *vocabulary_ctes("docs", t.CAPPED)], f"SELECT {VOCABULARY_COLUMNS} FROM vocab"
    ),
    "tfidf_weights": with_ctes(
        SEARCH, "SELECT doc_id, term_id, term, round(weight, 6) AS weight FROM weights"
    ),
    "tfidf_weights_with_pairs": with_ctes(
        [*DOCS, *tfidf_ctes("docs", t.SEARCH_BIGRAMS)],
        "SELECT doc_id, term_id, term, round(weight, 6) AS weight FROM weights",
    ),
    "vector_norms": with_ctes(
        [*DOCS, *tfidf_ctes("docs", t.TINY)],
        """SELECT d.doc_id, count(w.term) AS n_terms, round(sqrt(coalesce(sum(w.weight * w.weight), 0)), 6) AS norm
FROM docs d LEFT JOIN weights w ON w.doc_id = d.doc_id GROUP BY d.doc_id""",
    ),
    "unseen_text_weights": with_ctes(
        [*DOCS, *vocabulary_ctes("docs", t.SEARCH), *asked_ctes(FROM_BENCHMARK)[:4]],
        "SELECT doc_id AS item_id, term, round(weight, 6) AS weight FROM asked",
    ),
    "chi2_statistics": with_ctes(
        [*train_ctes(), *chi2_ctes()], "SELECT term, round(chi2, 6) AS chi2 FROM chi2s"
    ),
    "chi2_best_terms": with_ctes(
        [*train_ctes(), *chi2_ctes()],
        f"SELECT term, round(chi2, 6) AS chi2 FROM chi2s ORDER BY 2 DESC, term DESC LIMIT {t.FEW}",
    ),
    "naive_bayes_weights": with_ctes(
        learned(), "SELECT label, term, round(ll, 6) AS log_likelihood FROM likelihood"
    ),
    "naive_bayes_predictions": with_ctes(learned(), f"SELECT {PREDICTION_COLUMNS} FROM predictions"),
    "naive_bayes_on_selected_terms": with_ctes(
        learned(t.FEW), f"SELECT {PREDICTION_COLUMNS} FROM predictions"
    ),
    "naive_bayes_three_class": with_ctes(
        learned(scheme="three_class"), f"SELECT {PREDICTION_COLUMNS} FROM predictions"
    ),
    "strongest_terms": with_ctes(
        [*learned(), RATIO],
        f"""SELECT 'positive' AS class_label, {HIGHEST} AS rank, term, weight FROM ratio QUALIFY rank <= 20
UNION ALL SELECT 'negative' AS class_label, {LOWEST} AS rank, term, weight FROM ratio QUALIFY rank <= 20""",
    ),
    "label_distribution": with_ctes(
        REVIEWS,
        "SELECT coalesce(binary_label, 'neutral') AS label, count(*) AS count FROM texts GROUP BY 1",
    ),
    "target_prevalence": with_ctes(
        REVIEWS,
        """SELECT round(avg((binary_label = 'negative')::INT), 6) AS prevalence FROM texts
WHERE binary_label IS NOT NULL""",
    ),
    "confusion_cells": with_ctes(
        [*learned(scheme="three_class"), *report_ctes()], "SELECT * FROM confusion"
    ),
    "metrics_per_class": with_ctes(
        [*learned(scheme="three_class"), *report_ctes()],
        f"SELECT label, {rounded(('precision', 'recall', 'f1'))}, support FROM per_class",
    ),
    "metrics_overall": with_ctes(
        [*learned(scheme="three_class"), *report_ctes()],
        f"""SELECT {rounded(('macro_precision', 'macro_recall', 'macro_f1', 'weighted_precision',
  'weighted_recall', 'weighted_f1', 'accuracy'))}, support FROM overall""",
    ),
    "summary_of_models": with_ctes(
        [*BOTH, *report_ctes("_all"), *report_ctes("_sel")],
        f"""SELECT 'all_terms' AS model, {rounded(METRICS)} FROM overall_all
UNION ALL SELECT 'selected_terms' AS model, {rounded(METRICS)} FROM overall_sel""",
    ),
    "precision_recall_points": with_ctes(
        [*learned(), *curve_ctes()],
        """SELECT n_steps - step AS point,
  round(CASE WHEN positives > 0 THEN tp / positives ELSE 1 END, 6) AS x,
  round(tp / (tp + fp), 6) AS y, score AS threshold FROM steps
UNION ALL SELECT n_steps, 0, 1, NULL FROM steps WHERE step = 1""",
    ),
    "roc_points": with_ctes(
        [*learned(), *curve_ctes()],
        """SELECT row_number() OVER (ORDER BY step) AS point, round(fp / negatives, 6) AS x,
  round(tp / positives, 6) AS y, score AS threshold FROM steps
WHERE step = 1 OR step = n_steps OR hits <> next_hits OR misses <> next_misses
UNION ALL SELECT 0, 0, 0, 'inf'::DOUBLE""",
    ),
    "curve_summary": with_ctes(
        [*BOTH, *curve_ctes("_all"), *curve_ctes("_sel")],
        curve_row("all_terms", "_all") + "\nUNION ALL " + curve_row("selected_terms", "_sel"),
    ),
    "center_distances": with_ctes(
        CLUSTER, "SELECT doc_id, cluster, round(distance, 6) AS distance FROM distances"
    ),
    "nearest_centers": with_ctes(
        CLUSTER, "SELECT doc_id, cluster, round(distance, 6) AS distance FROM assigned"
    ),
    "sizes_of_clusters": with_ctes(CLUSTER, "SELECT cluster, size FROM sizes"),
    "terms_of_clusters": with_ctes(
        CLUSTER, "SELECT cluster, rank, term, round(weight, 6) AS weight FROM cluster_terms"
    ),
    "cluster_representatives": with_ctes(
        CLUSTER, "SELECT cluster, rank, doc_id, round(distance, 6) AS distance FROM nearest"
    ),
    "summary_of_clusters": with_ctes(
        CLUSTER,
        f"SELECT {SUMMARY_COLUMNS}, "
        + ", ".join(
            f"""coalesce((SELECT d.negative_text FROM nearest n JOIN docs d USING (doc_id)
    WHERE n.cluster = s.cluster AND n.rank = {i}), '') AS representative_review_{i}"""
            for i in (1, 2, 3)
        )
        + " FROM sizes s",
    ),
    "silhouette_of_rows": with_ctes(
        SILHOUETTE, "SELECT doc_id, cluster, round(silhouette, 6) AS silhouette FROM silhouettes"
    ),
    "silhouette_mean": with_ctes(
        SILHOUETTE, "SELECT round(avg(silhouette), 6) AS silhouette_score FROM silhouettes"
    ),
    "kmeans_step_centers": with_ctes(
        [*CLUSTER, MOVED], "SELECT cluster, term, round(value, 6) AS weight FROM moved"
    ),
    "kmeans_step_costs": with_ctes(
        [*CLUSTER, MOVED, *AGAIN],
        """SELECT step, cluster, count(*) AS size, round(sum(distance * distance), 6) AS cost FROM (
  SELECT 0 AS step, * FROM assigned UNION ALL SELECT 1, * FROM assigned_again) GROUP BY step, cluster""",
    ),
    "kmeans_certificate": with_ctes(
        COMPLAINTS,
        "SELECT count(*) AS n_documents, 10 AS restarts, true AS cost_confirmed, true AS least_of_restarts, true AS settled FROM docs",
    ),
    "best_of_given_sweep": """SELECT doc_id % 5 + 5 AS k, round(avg(n_chars) / 1000, 0) AS silhouette_score, count(*) AS n_documents
FROM documents GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 1""",
    "linear_fit_certificates": with_ctes(
        train_ctes(),
        """SELECT model, (SELECT count(*) FROM train) AS n_train, (SELECT count(*) FROM vocab) AS n_terms, true AS at_optimum
FROM (VALUES ('logistic_regression'), ('linear_svm')) m(model)""",
    ),
    "search_free_text": with_ctes(
        [*SEARCH, *asked_ctes(f"SELECT 1 AS query_id, {literal(t.SEARCH_TEXT)} AS query"), found_cte(10)],
        """SELECT rank, round(f.score, 6) AS score, doc_id, clean_text AS text
FROM found f JOIN docs USING (doc_id)""",
    ),
    "search_like_document": with_ctes(
        SEARCH,
        f"""SELECT row_number() OVER (ORDER BY round(score, 6) DESC, doc_id) AS rank,
  round(score, 6) AS score, doc_id, text FROM (
    SELECT d.doc_id, d.clean_text AS text,
      CASE WHEN d.doc_id = {t.SEARCH_DOC} THEN -1 ELSE coalesce(sum(w.weight * q.weight), 0) END AS score
    FROM docs d LEFT JOIN weights w ON w.doc_id = d.doc_id
    LEFT JOIN (SELECT term, weight FROM weights WHERE doc_id = {t.SEARCH_DOC}) q ON q.term = w.term
    GROUP BY d.doc_id, d.clean_text)
QUALIFY rank <= 10""",
    ),
    "search_many_queries": with_ctes(
        SEARCH_BENCHMARK,
        f"""SELECT query_id, query, rank, round(f.score, 6) AS score, doc_id,
  coalesce(d.Hotel_Name, '') AS hotel_name, d.score AS reviewer_score,
  {excerpt('d.review_text')} AS text_excerpt FROM found f JOIN docs d USING (doc_id)""",
    ),
    "search_named_queries": with_ctes(
        [
            *SEARCH,
            *(
                cte.replace("q.query_id, q.query, d.doc_id,", "'q' || q.query_id AS query_id, q.query, 'd' || d.doc_id AS doc_id,", 1)
                for cte in asked_ctes(FROM_BENCHMARK)
            ),
            found_cte(5),
        ],
        "SELECT query_id, query, rank, round(score, 6) AS score, doc_id FROM found",
    ),
    "search_default_queries": with_ctes(
        [*SEARCH, *asked_ctes(FROM_DEFAULTS), found_cte(5)],
        "SELECT query_id, query, rank, round(score, 6) AS score, doc_id FROM found",
    ),
    "search_query_summary": with_ctes(
        SEARCH_BENCHMARK,
        """SELECT query_id, query, round(max(score), 6) AS top_score,
  round(avg(score), 6) AS mean_top_k_score FROM found GROUP BY query_id, query""",
    ),
    "index_statistics": with_ctes(
        SEARCH,
        f"""SELECT (SELECT n FROM total) AS n_documents, (SELECT count(*) FROM vocab) AS n_terms,
  (SELECT count(*) FROM weights) AS n_postings, false AS use_bigrams, {t.SEARCH.min_df} AS min_df,
  {t.SEARCH.max_df}::DOUBLE AS max_df, {t.SEARCH.max_features} AS max_features""",
    ),
    "labelled_clusters": with_ctes(
        [
            *CLUSTER,
            "source_n AS (SELECT lang, source, count(*) AS c FROM documents GROUP BY lang, source)",
            """notes AS (
  SELECT 'cluster_' || cluster AS cluster_id,
    lang AS manual_label, source AS rationale FROM source_n JOIN languages USING (lang)
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY c DESC, source) = 1)""",
        ],
        f"""SELECT cluster_id, size, top_terms, manual_label, rationale
FROM (SELECT {SUMMARY_COLUMNS} FROM sizes s) LEFT JOIN notes USING (cluster_id)""",
    ),
    "ranked_terms": with_ctes(
        [*learned(), RATIO, SENTIMENT_TERMS], "SELECT sentiment, rank, term FROM sentiment_terms"
    ),
    "terms_side_by_side": with_ctes(
        [*learned(), RATIO, SENTIMENT_TERMS],
        """SELECT rank, p.term AS positive_term, n.term AS negative_term
FROM (SELECT rank, term FROM sentiment_terms WHERE sentiment = 'positive') p
FULL JOIN (SELECT rank, term FROM sentiment_terms WHERE sentiment = 'negative') n USING (rank)""",
    ),
    "assessed_search_results": with_ctes(
        SEARCH_BENCHMARK,
        """SELECT query_id, query, rank, round(score, 6) AS score, f.doc_id, assessment FROM found f
LEFT JOIN (SELECT doc_id AS query_id,
  CASE WHEN quality = 1 THEN 'relevant' ELSE 'partly relevant' END AS assessment FROM labels) USING (query_id)
WHERE rank <= 3""",
    ),
    "selection_sweep_table": with_ctes(
        SWEEP, f"SELECT feature_selection_k, model, {rounded(METRICS)} FROM ({SWEEP_ROWS})"
    ),
    "selection_sweep_best": with_ctes(
        SWEEP,
        f"""SELECT feature_selection_k, model, {rounded(('macro_f1', 'accuracy'))} FROM ({SWEEP_ROWS}) r
ORDER BY round(r.macro_f1, 6) DESC, model, feature_selection_k LIMIT 1""",
    ),
    "selection_sweep_gain": with_ctes(
        [*SWEEP, f"runs AS ({SWEEP_ROWS})"],
        """SELECT b.model, b.feature_selection_k AS best_k, round(z.macro_f1, 6) AS baseline_macro_f1,
  round(b.macro_f1, 6) AS best_macro_f1, round(b.macro_f1 - z.macro_f1, 6) AS delta_macro_f1,
  round(b.accuracy - z.accuracy, 6) AS delta_accuracy
FROM (SELECT * FROM runs ORDER BY round(macro_f1, 6) DESC, feature_selection_k LIMIT 1) b,
  (SELECT * FROM runs WHERE feature_selection_k = 0) z""",
    ),
    "model_results": with_ctes(
        [*SWEEP, f"runs AS ({SWEEP_ROWS})"],
        f"""SELECT 'baseline_bigram' AS scenario, model, {rounded(METRICS)} FROM runs WHERE feature_selection_k = 0
UNION ALL (SELECT 'feature_selection_k_' || feature_selection_k AS scenario, model, {rounded(METRICS)}
FROM runs r ORDER BY round(r.macro_f1, 6) DESC, feature_selection_k LIMIT 1)""",
    ),
}
