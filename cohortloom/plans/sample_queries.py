"""Registered queries over the ad samples and documents: tokens, encoders, rates, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import scalars, splitting
from cohortloom.functions.joins import join_audit, lookup
from cohortloom.functions.tokens import replace_tokens, shared_tokens, token_count
from cohortloom.operators import encoders, metrics, rates, screening, tokens
from cohortloom.plans import proxies
from cohortloom.plans.activity_queries import rounded
from cohortloom.plans.proxies import (
    AD_ATTRIBUTES, CATEGORIES, DOCUMENTS_SQL, SAMPLES_SQL, TOKEN_COLUMNS, USER_ATTRIBUTES,
)
from cohortloom.session import settle

KEYS = ["uid", "aid"]
KEPT = {"interest1": 9, "interest2": 20}
DOCUMENT_KEPT = {"text": 200}

ATTRIBUTE_AD = {a: [a, "aid"] for a in USER_ATTRIBUTES}
ATTRIBUTE_PAIR = {f"{u}_{a}": [u, a] for u in ("gender", "age") for a in AD_ATTRIBUTES}
THREE_KEYS = {
    f"{a}_{b}": [a, b, "aid"] for a, b in encoders.pair_names(["gender", "age", "lbs", "house"])
}
COUNT_BUCKET = {f"{a}_interest2cnt": [a, "interest2cnt", "aid"] for a in USER_ATTRIBUTES}
COMBOS = {
    "age_aid": ["age", "aid"],
    "gender_producttype": ["gender", "producttype"],
    "age_gender": ["age", "gender"],
    "age_gender_aid": ["age", "gender", "aid"],
    "age_gender_advertiserid": ["age", "gender", "advertiserid"],
}
SCREENED = {
    **{c: [c] for c in CATEGORIES},
    **{f"{a}X{b}": [a, b] for a, b in encoders.pair_names(USER_ATTRIBUTES)},
    **{f"{a}_aid": [a, "aid"] for a in USER_ATTRIBUTES},
}


def samples(spark, sf_dir):
    return proxies.marked_samples(spark, sf_dir)


def kept_samples(spark, sf_dir):
    """The samples as a table of their own, for queries that read them more than once."""
    return settle(samples(spark, sf_dir))


# --- fills, casts, strings ----------------------------------------------------------


def cleaned_samples(spark, sf_dir):
    """Fill, recode, constant, drop, place, cast and scale in one projection."""
    df = scalars.fill_missing(proxies.ad_samples(spark, sf_dir))
    df = df.select(
        "uid", "aid", *CATEGORIES, *TOKEN_COLUMNS,
        scalars.recode(F.col("label"), -1, 0).alias("label"),
        F.lit(1).cast("long").alias("cnt"),
        scalars.to_long(F.col("creativesize")).alias("size_number"),
        (scalars.to_long(F.col("lbs")) * 100.0).alias("lbs_scaled"),
    )
    return scalars.place_columns(df.drop("house"), "label", 2)


def test_rows_apart(spark, sf_dir):
    """Labelled and test rows by their mark, and the share of clicks among the labelled."""
    df = samples(spark, sf_dir)
    return df.groupBy(F.when(F.col("label") == -1, "test").otherwise("fit").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("uid").alias("users"),
        F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("clicks"),
    )


def stacked_samples(spark, sf_dir):
    """Fit and test rows stacked again, with a constant label on the test rows."""
    df = samples(spark, sf_dir).drop("is_train")
    stacked = splitting.stack_sets(df.filter(F.col("label") != -1), df.filter(F.col("label") == -1))
    return stacked.select("uid", "aid", "label", *CATEGORIES)


def token_count_features(spark, sf_dir):
    return samples(spark, sf_dir).select(
        *KEYS, *[token_count(F.col(c)).alias(f"{c}cnt") for c in TOKEN_COLUMNS]
    )


def pair_crosses(spark, sf_dir):
    return encoders.cross_pairs(samples(spark, sf_dir), KEYS, CATEGORIES)


def replaced_token(spark, sf_dir):
    return samples(spark, sf_dir).select(
        *KEYS, *[replace_tokens(F.col(c), ["red", "Brand#1"]).alias(c) for c in TOKEN_COLUMNS]
    )


def tokens_in_common(spark, sf_dir):
    wanted = ["red", "widget", "old"]
    return samples(spark, sf_dir).select(
        *KEYS, F.array_join(shared_tokens(F.col("interest1"), wanted), " ").alias("common")
    )


def ranked_tokens(spark, sf_dir):
    """Every token of the whole document texts with its rank by frequency."""
    documents = proxies.documents(spark, sf_dir)
    return tokens.rank_tokens(tokens.token_importance(documents, ["text"], lower=True))


def first_token_cut(spark, sf_dir):
    """The first token to fall away per column."""
    ranked = tokens.rank_tokens(tokens.token_importance(samples(spark, sf_dir), TOKEN_COLUMNS))
    return tokens.nth_token(ranked, KEPT).select("feature", "token", "position")


def collapsed_samples(spark, sf_dir):
    df = kept_samples(spark, sf_dir)
    return tokens.keep_top(df, KEYS, tokens.token_importance(df, TOKEN_COLUMNS), KEPT)


def collapsed_documents(spark, sf_dir):
    """Rare tokens of whole documents, by the join that has no limit on their number."""
    documents = proxies.documents(spark, sf_dir)
    ranked = tokens.rank_tokens(tokens.token_importance(documents, ["text"]))
    rare = tokens.rare_tokens(ranked, DOCUMENT_KEPT)
    out = tokens.collapse_rare(documents, ["doc_id"], rare, ["text"], literal_tokens=0)
    return out.select("doc_id", F.md5("text").alias("text_md5"), token_count(F.col("text")).alias("n_tokens"))


# --- encoders -------------------------------------------------------------------------


def label_codes(spark, sf_dir):
    return encoders.fit_codes(samples(spark, sf_dir), CATEGORIES)


def encoded_samples(spark, sf_dir):
    df = kept_samples(spark, sf_dir)
    coded = encoders.encode(df, encoders.fit_codes(df, CATEGORIES), CATEGORIES)
    return coded.select(*KEYS, *[f"{c}_code" for c in CATEGORIES])


def one_hot_rows(spark, sf_dir):
    df = kept_samples(spark, sf_dir)
    coded = encoders.encode(df, encoders.fit_codes(df, USER_ATTRIBUTES), USER_ATTRIBUTES)
    return encoders.one_hot_rows(coded, KEYS, USER_ATTRIBUTES)


def token_vocabulary(spark, sf_dir):
    return encoders.fit_vocabulary(proxies.documents(spark, sf_dir), ["text"])


def document_token_counts(spark, sf_dir):
    documents = proxies.documents(spark, sf_dir)
    vocabulary = encoders.fit_vocabulary(documents, ["text"])
    return encoders.token_count_rows(documents, ["doc_id"], ["text"], vocabulary)


def feature_dictionary(spark, sf_dir):
    """Levels of the categories and tokens of the token columns in one dictionary."""
    df = kept_samples(spark, sf_dir)
    return encoders.fit_codes(df, CATEGORIES).unionByName(encoders.fit_vocabulary(df, TOKEN_COLUMNS))


def design_rows(spark, sf_dir):
    """All blocks side by side as (uid, aid, column, value)."""
    df = kept_samples(spark, sf_dir)
    codes = settle(encoders.fit_codes(df, USER_ATTRIBUTES))
    vocabulary = settle(encoders.fit_vocabulary(df, TOKEN_COLUMNS))
    blocks = encoders.one_hot_rows(encoders.encode(df, codes, USER_ATTRIBUTES), KEYS, USER_ATTRIBUTES)
    blocks = blocks.unionByName(encoders.token_count_rows(df, KEYS, TOKEN_COLUMNS, vocabulary))
    sizes = encoders.widths(codes.unionByName(vocabulary))
    return encoders.matrix_rows(blocks, sizes, USER_ATTRIBUTES + TOKEN_COLUMNS)


# --- click rates ------------------------------------------------------------------------


def _rates(features):
    def run(spark, sf_dir):
        table = rates.click_rates(samples(spark, sf_dir), features)
        return rounded(table)

    return run


def _attached(features, gap=None):
    def run(spark, sf_dir):
        df = kept_samples(spark, sf_dir)
        out = rates.attach_rates(df.select(*KEYS, *CATEGORIES), rates.click_rates(df, features), features, gap=gap)
        return rounded(out.select(*KEYS, *[f"{f}_ctr" for f in features]))

    return run


def ctr_count_bucket(spark, sf_dir):
    """Rates by an attribute, the number of interests and the ad, looked up for every sample."""
    df = kept_samples(spark, sf_dir).withColumn("interest2cnt", token_count(F.col("interest2")))
    out = rates.attach_rates(df.select(*KEYS, *CATEGORIES, "interest2cnt"), rates.click_rates(df, COUNT_BUCKET), COUNT_BUCKET)
    return rounded(out.select(*KEYS, *[f"{f}_ctr" for f in COUNT_BUCKET]))


def out_of_fold(spark, sf_dir):
    """Rates of training rows that leave out their own fold, per key and fold."""
    train = kept_samples(spark, sf_dir).filter("is_train = 1")
    train = train.withColumn("own", F.pmod(F.col("uid") * 7 + F.col("aid") * 3, F.lit(5)).cast("int"))
    return rounded(rates.out_of_fold_rates(train, KEYS, ATTRIBUTE_PAIR, own_fold="own"))


def ctr_likelihood(spark, sf_dir):
    """Rates smoothed by the beta distribution of the greatest likelihood."""
    table = rates.click_rates(samples(spark, sf_dir), ATTRIBUTE_PAIR)
    return rounded(rates.smooth_by_likelihood(table, tol=1e-5, rounds=40), 4)


def ctr_token_bucket(spark, sf_dir):
    """Two lookups in a row: interest text to its count bucket, bucket and ad to the rate."""
    df = kept_samples(spark, sf_dir)
    buckets = df.select("uid", "interest2").distinct().withColumn(
        "interest2cnt", token_count(F.col("interest2"))
    )
    counted = lookup(df, buckets, ["uid", "interest2"])
    features = {"interest2cnt": ["interest2cnt", "aid"]}
    table = rates.click_rates(counted, features)
    out = rates.attach_rates(counted.select(*KEYS, "interest2cnt"), table, features)
    return rounded(out)


def ctr_smoothed(spark, sf_dir):
    table = rates.smooth_rates(rates.click_rates(samples(spark, sf_dir), {**ATTRIBUTE_AD, **ATTRIBUTE_PAIR}))
    return rounded(table.drop("ctr"))


def ctr_tokens(spark, sf_dir):
    return rounded(rates.token_pair_rates(kept_samples(spark, sf_dir), TOKEN_COLUMNS))


def ad_exposures(spark, sf_dir):
    df = kept_samples(spark, sf_dir)
    out = lookup(df.select(*KEYS), rates.exposures(df), ["aid"])
    return out


def history_rates(spark, sf_dir):
    """History rate of single keys: ad, place, producer."""
    df = kept_samples(spark, sf_dir)
    features = {"aid": ["aid"], "lbs": ["lbs"], "advertiserid": ["advertiserid"], "producttype": ["producttype"]}
    out = rates.attach_rates(df.select(*KEYS, "lbs", "advertiserid", "producttype"), rates.click_rates(df, features), features)
    return rounded(out.select(*KEYS, *[f"{f}_ctr" for f in features]))


def combined_keys(spark, sf_dir):
    return rates.combined_keys(samples(spark, sf_dir), COMBOS)


def combined_codes(spark, sf_dir):
    """Combined keys, label-encoded: one code column per combination."""
    df = kept_samples(spark, sf_dir)
    wide = df.select(*KEYS, *[F.concat_ws(" ", *cs).alias(n) for n, cs in COMBOS.items()])
    coded = encoders.encode(wide, encoders.fit_codes(wide, list(COMBOS)), list(COMBOS))
    return coded.select(*KEYS, *[f"{n}_code" for n in COMBOS])


def combination_counts(spark, sf_dir):
    return rates.attach_counts(kept_samples(spark, sf_dir), COMBOS)


def pair_shares(spark, sf_dir):
    return rounded(rates.pair_shares(samples(spark, sf_dir), AD_ATTRIBUTES, USER_ATTRIBUTES))


def widened_pairs(spark, sf_dir):
    """Four (uid, aid) tables made wide and joined once."""
    df = kept_samples(spark, sf_dir)
    features = {c: [c] for c in USER_ATTRIBUTES}
    wanted = rates.attach_rates(df.select(*KEYS, *USER_ATTRIBUTES), rates.click_rates(df, features), features)
    tables = wanted.selectExpr(
        *KEYS,
        f"stack({len(features)}, {', '.join(f'{c!r}, {c}_ctr' for c in features)}) AS (feature, value)",
    )
    wide = rates.widen_pairs(tables, list(features))
    return rounded(df.select(*KEYS).join(wide, KEYS, "left"))


def lookup_audit(spark, sf_dir):
    """What three lookups would do to the number of rows."""
    df = kept_samples(spark, sf_dir)
    part = proxies.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("aid"))
    lines = proxies.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("aid"))
    events = proxies.table(spark, sf_dir, "events").select(F.col("user_id").alias("uid"))
    return (
        join_audit(df, part, ["aid"], "parts")
        .unionByName(join_audit(df, lines, ["aid"], "lines"))
        .unionByName(join_audit(df, events, ["uid"], "events"))
    )


# --- metrics and screens ------------------------------------------------------------------


def auc_all(spark, sf_dir):
    return rounded(metrics.roc_auc(proxies.scored_lines(spark, sf_dir)))


def auc_by_part(spark, sf_dir):
    return rounded(metrics.roc_auc(proxies.scored_lines(spark, sf_dir), ["part"]))


def best_f1_all(spark, sf_dir):
    return rounded(metrics.best_f1(proxies.scored_lines(spark, sf_dir)))


def best_f1_by_part(spark, sf_dir):
    return rounded(metrics.best_f1(proxies.scored_lines(spark, sf_dir), ["part"]))


def feature_screen(spark, sf_dir):
    return rounded(screening.screen_features(samples(spark, sf_dir), SCREENED))


def token_cut_search(spark, sf_dir):
    """The cut curve of one token column: every number of kept tokens."""
    return rounded(screening.cut_curve(samples(spark, sf_dir), "interest1"))


def document_cut_search(spark, sf_dir):
    """The cut curve over the whole vocabulary of the labelled texts."""
    return rounded(screening.cut_curve(proxies.labelled_documents(spark, sf_dir), "text"))


QUERIES = {
    "cleaned_samples": cleaned_samples,
    "test_rows_apart": test_rows_apart,
    "stacked_samples": stacked_samples,
    "token_count_features": token_count_features,
    "pair_crosses": pair_crosses,
    "replaced_token": replaced_token,
    "tokens_in_common": tokens_in_common,
    "ranked_tokens": ranked_tokens,
    "first_token_cut": first_token_cut,
    "collapsed_samples": collapsed_samples,
    "collapsed_documents": collapsed_documents,
    "label_codes": label_codes,
    "encoded_samples": encoded_samples,
    "one_hot_rows": one_hot_rows,
    "token_vocabulary": token_vocabulary,
    "document_token_counts": document_token_counts,
    "feature_dictionary": feature_dictionary,
    "design_rows": design_rows,
    "ctr_attribute_ad": _attached(ATTRIBUTE_AD),
    "ctr_attribute_ad_table": _rates(ATTRIBUTE_AD),
    "ctr_attribute_pair": _attached(ATTRIBUTE_PAIR),
    "ctr_three_keys": _attached(THREE_KEYS),
    "ctr_three_keys_table": _rates(THREE_KEYS),
    "ctr_token_bucket": ctr_token_bucket,
    "ctr_count_bucket": ctr_count_bucket,
    "ctr_likelihood": ctr_likelihood,
    "out_of_fold": out_of_fold,
    "ctr_smoothed": ctr_smoothed,
    "ctr_gaps_filled": _attached(ATTRIBUTE_AD, gap=0.0),
    "ctr_tokens": ctr_tokens,
    "ad_exposures": ad_exposures,
    "history_rates": history_rates,
    "combined_keys": combined_keys,
    "combined_codes": combined_codes,
    "combination_counts": combination_counts,
    "pair_shares": pair_shares,
    "widened_pairs": widened_pairs,
    "lookup_audit": lookup_audit,
    "auc_all": auc_all,
    "auc_by_part": auc_by_part,
    "best_f1_all": best_f1_all,
    "best_f1_by_part": best_f1_by_part,
    "feature_screen": feature_screen,
    "token_cut_search": token_cut_search,
    "document_cut_search": document_cut_search,
}


# --- SQL ----------------------------------------------------------------------------------


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join([SAMPLES_SQL, *ctes]) + " "


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _count_sql(column: str) -> str:
    return f"CAST(CASE WHEN {column} = '-1' THEN -1 ELSE len(string_split({column}, ' ')) END AS BIGINT)"


def _tokens_cte(name: str, source: str, columns, keys: str = "", lower: bool = False) -> str:
    k = f"{keys}, " if keys else ""
    parts = [
        f"SELECT {k}'{c}' AS feature, unnest(string_split({f'lower({c})' if lower else c}, ' ')) AS token FROM {source}"
        for c in columns
    ]
    return f"{name} AS ({_union(parts)})"


def _ranked_cte(name: str, source: str) -> str:
    return f"""{name} AS (SELECT feature, token, CAST(count(*) AS DOUBLE) AS importance,
      row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, token) AS position
      FROM {source} WHERE token <> '-1' GROUP BY feature, token)"""


def _rare_cte(name: str, ranked: str, kept: dict) -> str:
    limit = " ".join(f"WHEN '{f}' THEN {n}" for f, n in kept.items())
    return f"{name} AS (SELECT feature, token FROM {ranked} WHERE position > CASE feature {limit} END)"


def _codes_cte(name: str, source: str, columns) -> str:
    levels = _union(f"SELECT DISTINCT '{c}' AS feature, CAST({c} AS VARCHAR) AS val FROM {source}" for c in columns)
    return f"""{name}_levels AS ({levels}),
      {name}_kinds AS (SELECT feature, bool_and(TRY_CAST(val AS BIGINT) IS NOT NULL) AS is_number FROM {name}_levels GROUP BY 1),
      {name} AS (SELECT feature, val, row_number() OVER (PARTITION BY feature ORDER BY
        CASE WHEN is_number THEN TRY_CAST(val AS BIGINT) END, CASE WHEN NOT is_number THEN val END) - 1 AS "index"
        FROM {name}_levels JOIN {name}_kinds USING (feature))"""


def _coded_sql(source: str, columns, codes: str = "codes") -> str:
    joins = " ".join(
        f"LEFT JOIN {codes} c{i} ON c{i}.feature = '{c}' AND c{i}.val = CAST(s.{c} AS VARCHAR)"
        for i, c in enumerate(columns)
    )
    wanted = ", ".join(f'c{i}."index" AS {c}_code' for i, c in enumerate(columns))
    return f"SELECT uid, aid, {wanted} FROM {source} s {joins}"


def _hot_sql(columns) -> str:
    parts = [
        f"""SELECT uid, aid, '{c}' AS feature, "index", CAST(1 AS DOUBLE) AS value FROM samples s
        JOIN codes ON feature = '{c}' AND val = s.{c}""" for c in columns
    ]
    return _union(parts)


def _rate_sql(feature: str, columns, depth: int, source: str = "samples") -> str:
    keys = [f"CAST({c} AS VARCHAR) AS key{i + 1}" for i, c in enumerate(columns)]
    keys += [f"CAST(NULL AS VARCHAR) AS key{i + 1}" for i in range(len(columns), depth)]
    return f"""SELECT '{feature}' AS feature, {', '.join(keys)}, CAST(sum(label) AS BIGINT) AS clicks,
      count(*) AS exposures FROM {source} WHERE label <> -1 GROUP BY {', '.join(columns)}"""


def _rates_cte(features, source: str = "samples") -> str:
    depth = max(len(c) for c in features.values())
    return f"rates AS ({_union(_rate_sql(f, c, depth, source) for f, c in features.items())})"


def _rates_sql(features) -> str:
    depth = max(len(c) for c in features.values())
    keys = ", ".join(f"key{i + 1}" for i in range(depth))
    return _with(_rates_cte(features)) + f"""SELECT feature, {keys}, clicks, exposures,
      round(clicks / exposures * 100.0, 6) AS ctr FROM rates"""


def _attached_sql(features, gap=None, source: str = "samples", extra: str = "") -> str:
    joins, wanted = [], []
    for i, (f, columns) in enumerate(features.items()):
        on = " AND ".join(f"r{i}.key{k + 1} = CAST(s.{c} AS VARCHAR)" for k, c in enumerate(columns))
        joins.append(f"LEFT JOIN rates r{i} ON r{i}.feature = '{f}' AND {on}")
        value = f"round(r{i}.clicks / r{i}.exposures * 100.0, 6)"
        wanted.append(f"{f'coalesce({value}, {gap})' if gap is not None else value} AS {f}_ctr")
    return f"SELECT uid, aid{extra}, {', '.join(wanted)} FROM {source} s {' '.join(joins)}"


def _own_rates_sql(features, gap=None, source: str = "samples") -> str:
    """Rates of the keys of each row by windows, for features counted over the same rows."""
    wanted = []
    for f, columns in features.items():
        over = f"OVER (PARTITION BY {', '.join(columns)})"
        known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
        rate = f"sum(label) FILTER (label <> -1) {over} / nullif(count(*) FILTER (label <> -1) {over}, 0) * 100.0"
        value = f"round(CASE WHEN {known} THEN {rate} END, 6)"
        wanted.append(f"{f'coalesce({value}, {gap})' if gap is not None else value} AS {f}_ctr")
    return f"SELECT uid, aid, {', '.join(wanted)} FROM {source}"


def _auc_sql(source: str, by: str = "") -> str:
    group = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    tail = f"GROUP BY {by}" if by else ""
    return f"""WITH s AS ({source}),
      g AS (SELECT {group}score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM s GROUP BY {group}score),
      c AS (SELECT *, sum(neg) OVER ({part} ORDER BY score) - neg AS below FROM g)
      SELECT {group}CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
        round(sum(pos * (below + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS auc FROM c {tail}"""


def _f1_sql(source: str, by: str = "") -> str:
    group = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""WITH s AS ({source}),
      g AS (SELECT {group}score, count(*) FILTER (label = 1) AS pos, count(*) AS n FROM s GROUP BY {group}score),
      c AS (SELECT {group}score, 2.0 * sum(pos) OVER ({part} ORDER BY score DESC)
              / (sum(n) OVER ({part} ORDER BY score DESC) + sum(pos) OVER ({part})) AS f1 FROM g)
      SELECT {group}'f1_score' AS name, round(CAST(f1 AS DOUBLE), 6) AS f1, round(score, 6) AS threshold, true AS higher_is_better
      FROM c QUALIFY row_number() OVER ({part} ORDER BY f1 DESC, score) = 1"""


_LINES = """SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_discount AS score,
  CAST(l_linenumber AS BIGINT) AS part FROM lineitem"""

FOUR = """count(*) FILTER (is_train = 1 AND label = 1) AS tp, count(*) FILTER (is_train = 1 AND label <> 1) AS tn,
  count(*) FILTER (is_train <> 1 AND label = 1) AS vp, count(*) FILTER (is_train <> 1 AND label <> 1) AS vn"""


def two_auc_tail(by: str, source: str, more: str = "") -> str:
    return f"""b AS (SELECT *, sum(tn) OVER (PARTITION BY {by} ORDER BY score) - tn AS tb,
        sum(vn) OVER (PARTITION BY {by} ORDER BY score) - vn AS vb FROM {source}),
      a AS (SELECT {by}, round(CAST(sum(tp * (tb + tn / 2.0)) AS DOUBLE) / nullif(CAST(sum(tp) AS DOUBLE) * CAST(sum(tn) AS DOUBLE), 0), 6) AS AUC_0,
        round(CAST(sum(vp * (vb + vn / 2.0)) AS DOUBLE) / nullif(CAST(sum(vp) AS DOUBLE) * CAST(sum(vn) AS DOUBLE), 0), 6) AS AUC_1
        FROM b GROUP BY {by})"""


def _screen_sql() -> str:
    parts = []
    for f, columns in SCREENED.items():
        parts.append(f"SELECT '{f}' AS var_name, {FOUR} FROM samples WHERE label <> -1 GROUP BY {', '.join(columns)}")
    return _with(
        f"levels AS ({_union(parts)})",
        "overall AS (SELECT var_name, CAST(sum(tp) AS DOUBLE) / CAST(sum(tp + tn) AS DOUBLE) AS o FROM levels GROUP BY 1)",
        """scored AS (SELECT var_name, CASE WHEN tp + tn > 0 THEN tp / (tp + tn) ELSE o END AS score,
           sum(tp) AS tp, sum(tn) AS tn, sum(vp) AS vp, sum(vn) AS vn FROM levels JOIN overall USING (var_name) GROUP BY 1, 2)""",
        two_auc_tail("var_name", "scored"),
    ) + "SELECT var_name, AUC_0, AUC_1 FROM a"


def _cut_sql(cte: str, source: str, column: str) -> str:
    """Every cut built anew: for short vocabularies."""
    return f"""WITH {cte},
      t AS (SELECT unnest(string_split({column}, ' ')) AS token, label, is_train FROM {source} WHERE label <> -1),
      k AS (SELECT token, {FOUR}, row_number() OVER (ORDER BY count(*) DESC, token) AS pos
            FROM t WHERE token <> '-1' GROUP BY token),
      cuts AS (SELECT pos AS kept FROM k),
      merged AS (SELECT CAST(kept AS BIGINT) AS kept, CASE WHEN pos <= kept THEN pos ELSE 0 END AS slot,
        sum(tp) AS tp, sum(tn) AS tn, sum(vp) AS vp, sum(vn) AS vn FROM cuts CROSS JOIN k GROUP BY 1, 2),
      scored AS (SELECT kept, CASE WHEN tp + tn > 0 THEN tp / (tp + tn) ELSE 0 END AS score,
        sum(tp) AS tp, sum(tn) AS tn, sum(vp) AS vp, sum(vn) AS vn FROM merged GROUP BY 1, 2),
      {two_auc_tail('kept', 'scored')},
      cover AS (SELECT kept, round(1 - CAST(sum(tp + tn + vp + vn) FILTER (slot = 0) AS DOUBLE) / CAST(sum(tp + tn + vp + vn) AS DOUBLE), 6) AS coverage
        FROM merged GROUP BY 1)
      SELECT kept, kept + 1 AS cut_num, coalesce(coverage, 1.0) AS coverage, AUC_0, AUC_1 FROM a JOIN cover USING (kept)"""


def _cut_curve_sql(cte: str, source: str, column: str) -> str:
    """Every cut from the one before it: running counts per distinct score, at every rank."""

    def below(weight: str, score: str) -> str:
        return f"sum({weight} * CASE WHEN score < {score} THEN 1 WHEN score = {score} THEN 0.5 ELSE 0 END)"

    four = ("tp", "tn", "vp", "vn")
    sums = ", ".join(f"{below(w, score)} AS {w}_{score}" for w in four for score in ("s", "b"))
    grown = ", ".join(f"sum(CASE WHEN s = score THEN {w} ELSE 0 END) OVER (PARTITION BY score ORDER BY pos) AS {w}" for w in four)
    rest = {w: f"(sum({w}) OVER () - sum({w}) OVER (ORDER BY pos))" for w in ("tp", "tn", "vp", "vn")}
    left = ", ".join(f"CAST({e} AS DOUBLE) AS {w}_left" for w, e in rest.items())

    def area(p: str, n: str) -> str:
        return f"""round((sum({p} * {n}_s + {n} * (sum_{p} - {p}_s) - {p} * {n} / 2.0) OVER (ORDER BY pos)
          + {p}_left * {n}_b + {n}_left * (sum_{p} - {p}_b) + {p}_left * {n}_left / 2) / nullif(all_{p} * all_{n}, 0), 6)"""

    whole = ", ".join(f"CAST(sum({w}) OVER () AS DOUBLE) AS all_{w}, CAST(sum({w}) OVER (ORDER BY pos) AS DOUBLE) AS sum_{w}" for w in rest)
    return f"""WITH {cte},
      t AS (SELECT unnest(string_split({column}, ' ')) AS token, label, is_train FROM {source} WHERE label <> -1),
      k AS (SELECT token, {FOUR}, row_number() OVER (ORDER BY count(*) DESC, token) AS pos
            FROM t WHERE token <> '-1' GROUP BY token),
      r AS (SELECT *, CASE WHEN tp + tn > 0 THEN tp / (tp + tn) ELSE 0 END AS s, {left}, {whole} FROM k),
      q AS (SELECT *, CASE WHEN tp_left + tn_left > 0 THEN tp_left / (tp_left + tn_left) ELSE 0 END AS b FROM r),
      g AS (SELECT pos, s, b, score, {grown} FROM q, (SELECT DISTINCT s AS score FROM q)),
      d AS (SELECT pos, {sums} FROM g GROUP BY pos)
      SELECT CAST(pos AS BIGINT) AS kept, CAST(pos AS BIGINT) + 1 AS cut_num,
        round(1 - (tp_left + tn_left + vp_left + vn_left) / (all_tp + all_tn + all_vp + all_vn), 6) AS coverage,
        {area('tp', 'tn')} AS AUC_0, {area('vp', 'vn')} AS AUC_1
      FROM q JOIN d USING (pos)"""


def _audit_sql(name: str, table: str, key: str) -> str:
    return f"""SELECT '{name}' AS lookup, CAST(sum(n) AS BIGINT) AS rows_before, CAST(sum(n * greatest(coalesce(m, 0), 1)) AS BIGINT) AS rows_after,
      CAST(coalesce(sum(n) FILTER (m IS NULL), 0) AS BIGINT) AS unmatched_rows, CAST((SELECT count(*) FROM ({table}) WHERE m > 1) AS BIGINT) AS double_keys
      FROM (SELECT {key} AS k, count(*) AS n FROM samples GROUP BY 1) LEFT JOIN ({table}) USING (k)"""


_CATS = ", ".join(CATEGORIES)

ORACLES = {
    "cleaned_samples": _with() + f"""SELECT uid, aid, CASE WHEN label = -1 THEN 0 ELSE label END AS label,
      {', '.join(c for c in CATEGORIES if c != 'house')}, {', '.join(TOKEN_COLUMNS)}, CAST(1 AS BIGINT) AS cnt,
      TRY_CAST(creativesize AS BIGINT) AS size_number, CAST(TRY_CAST(lbs AS BIGINT) * 100.0 AS DOUBLE) AS lbs_scaled FROM samples""",
    "test_rows_apart": _with() + """SELECT CASE WHEN label = -1 THEN 'test' ELSE 'fit' END AS part, count(*) AS n,
      count(DISTINCT uid) AS users, count(*) FILTER (label = 1) AS clicks FROM samples GROUP BY 1""",
    "stacked_samples": _with() + f"SELECT uid, aid, label, {_CATS} FROM samples",
    "token_count_features": _with() + f"SELECT uid, aid, {', '.join(f'{_count_sql(c)} AS {c}cnt' for c in TOKEN_COLUMNS)} FROM samples",
    "pair_crosses": _with() + "SELECT uid, aid, " + ", ".join(
        f"{a} || ' ' || {b} AS {a}X{b}" for a, b in encoders.pair_names(CATEGORIES)) + " FROM samples",
    "replaced_token": _with() + "SELECT uid, aid, " + ", ".join(
        f"array_to_string(list_transform(string_split({c}, ' '), lambda t: CASE WHEN t IN ('red', 'Brand#1') THEN 'other' ELSE t END), ' ') AS {c}"
        for c in TOKEN_COLUMNS) + " FROM samples",
    "tokens_in_common": _with() + """SELECT uid, aid, array_to_string(list_sort(list_intersect(string_split(interest1, ' '),
      ['red', 'widget', 'old'])), ' ') AS common FROM samples""",
    "ranked_tokens": f"WITH {_tokens_cte('t', 'documents', ['text'], lower=True)}, {_ranked_cte('r', 't')} SELECT * FROM r",
    "first_token_cut": _with(_tokens_cte("t", "samples", TOKEN_COLUMNS), _ranked_cte("r", "t")) +
        "SELECT feature, token, position FROM r WHERE position = CASE feature " +
        " ".join(f"WHEN '{f}' THEN {n}" for f, n in KEPT.items()) + " END + 1",
    "collapsed_samples": _with(_tokens_cte("t", "samples", TOKEN_COLUMNS), _ranked_cte("r", "t"), _rare_cte("rare", "r", KEPT),
        *[f"""p_{c} AS (SELECT uid, aid, unnest(string_split({c}, ' ')) AS token,
            generate_subscripts(string_split({c}, ' '), 1) AS place FROM samples),
          o_{c} AS (SELECT uid, aid, string_agg(CASE WHEN rare.token IS NOT NULL THEN 'other' ELSE p_{c}.token END, ' ' ORDER BY place) AS {c}
            FROM p_{c} LEFT JOIN rare ON rare.feature = '{c}' AND rare.token = p_{c}.token GROUP BY 1, 2)""" for c in TOKEN_COLUMNS]) +
        f"SELECT uid, aid, {', '.join(TOKEN_COLUMNS)} FROM " + " JOIN ".join(
            f"o_{c}" if i == 0 else f"o_{c} USING (uid, aid)" for i, c in enumerate(TOKEN_COLUMNS)),
    "collapsed_documents": f"""WITH d AS (SELECT doc_id, 'text' AS feature, unnest(string_split(text, ' ')) AS token,
        generate_subscripts(string_split(text, ' '), 1) AS place FROM documents),
      {_ranked_cte('r', 'd')}, {_rare_cte('rare', 'r', DOCUMENT_KEPT)},
      o AS (SELECT doc_id, string_agg(CASE WHEN rare.token IS NOT NULL THEN 'other' ELSE d.token END, ' ' ORDER BY place) AS text, count(*) AS n
        FROM d LEFT JOIN rare ON rare.token = d.token GROUP BY 1)
      SELECT doc_id, md5(text) AS text_md5, {_count_sql('text')} AS n_tokens FROM o""",
    "label_codes": _with(_codes_cte("codes", "samples", CATEGORIES)) + 'SELECT feature, val, "index" FROM codes',
    "encoded_samples": _with(_codes_cte("codes", "samples", CATEGORIES)) + _coded_sql("samples", CATEGORIES),
    "one_hot_rows": _with(_codes_cte("codes", "samples", USER_ATTRIBUTES)) + _hot_sql(USER_ATTRIBUTES),
    "token_vocabulary": f"""WITH {_tokens_cte('t', 'documents', ['text'], lower=True)} SELECT feature, token AS val,
      row_number() OVER (ORDER BY token) - 1 AS "index" FROM t GROUP BY 1, 2""",
    "document_token_counts": f"""WITH {_tokens_cte('t', 'documents', ['text'], 'doc_id', lower=True)},
      v AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS "index" FROM t GROUP BY 1)
      SELECT doc_id, feature, "index", CAST(count(*) AS DOUBLE) AS value FROM t JOIN v USING (token) GROUP BY ALL""",
    "feature_dictionary": _with(_codes_cte("codes", "samples", CATEGORIES), _tokens_cte("t", "samples", TOKEN_COLUMNS, lower=True)) +
        """SELECT feature, val, "index" FROM codes UNION ALL
        SELECT feature, token, row_number() OVER (PARTITION BY feature ORDER BY token) - 1 FROM t GROUP BY 1, 2""",
    "design_rows": _with(
        _codes_cte("codes", "samples", USER_ATTRIBUTES), _tokens_cte("t", "samples", TOKEN_COLUMNS, "uid, aid", lower=True),
        """vocab AS (SELECT feature, token AS val, row_number() OVER (PARTITION BY feature ORDER BY token) - 1 AS "index" FROM t GROUP BY 1, 2)""",
        f"""blocks AS ({_hot_sql(USER_ATTRIBUTES)} UNION ALL SELECT uid, aid, t.feature, "index", CAST(count(*) AS DOUBLE)
          FROM t JOIN vocab v ON v.feature = t.feature AND v.val = t.token GROUP BY ALL)""",
        f"""sizes AS (SELECT feature, count(*) AS n, list_position([{', '.join(repr(c) for c in USER_ATTRIBUTES + TOKEN_COLUMNS)}], feature) AS place
          FROM (SELECT feature, val FROM codes UNION ALL SELECT feature, val FROM vocab) GROUP BY 1)""",
        "starts AS (SELECT feature, CAST(sum(n) OVER (ORDER BY place) - n AS BIGINT) AS start FROM sizes)") +
        'SELECT uid, aid, "index" + start AS "column", value FROM blocks JOIN starts USING (feature)',
    "ctr_attribute_ad": _with() + _own_rates_sql(ATTRIBUTE_AD),
    "ctr_attribute_ad_table": _rates_sql(ATTRIBUTE_AD),
    "ctr_attribute_pair": _with() + _own_rates_sql(ATTRIBUTE_PAIR),
    "ctr_three_keys": _with() + _own_rates_sql(THREE_KEYS),
    "ctr_three_keys_table": _rates_sql(THREE_KEYS),
    "ctr_token_bucket": _with(f"counted AS (SELECT *, {_count_sql('interest2')} AS interest2cnt FROM samples)",
        _rates_cte({"interest2cnt": ["interest2cnt", "aid"]}, "counted")) +
        _attached_sql({"interest2cnt": ["interest2cnt", "aid"]}, source="counted", extra=", interest2cnt"),
    "ctr_count_bucket": _with(f"counted AS (SELECT *, {_count_sql('interest2')} AS interest2cnt FROM samples)")
        + _own_rates_sql(COUNT_BUCKET, source="counted"),
    "out_of_fold": _with(
        "train AS (SELECT *, CAST((uid * 7 + aid * 3) % 5 AS INTEGER) AS fold FROM samples WHERE label <> -1 AND is_train = 1)",
        "per AS (" + _union(
            f"""SELECT '{f}' AS feature, CAST({a} AS VARCHAR) AS key1, CAST({b} AS VARCHAR) AS key2, fold, sum(label) AS c, count(*) AS n
              FROM train GROUP BY ALL""" for f, (a, b) in ATTRIBUTE_PAIR.items()
        ) + ")",
        """o AS (SELECT feature, key1, key2, fold, CAST(sum(c) OVER k - c AS BIGINT) AS clicks, CAST(sum(n) OVER k - n AS BIGINT) AS exposures
           FROM per WINDOW k AS (PARTITION BY feature, key1, key2))""",
    ) + "SELECT *, round(clicks / nullif(exposures, 0) * 100.0, 6) AS ctr FROM o",
    "ctr_smoothed": _with(_rates_cte({**ATTRIBUTE_AD, **ATTRIBUTE_PAIR}),
        "m AS (SELECT feature, avg(clicks / exposures) AS mean, var_samp(clicks / exposures) AS var FROM rates GROUP BY 1)",
        "s AS (SELECT feature, mean, CASE WHEN var > 0 THEN mean * (1 - mean) / var - 1 END AS strength FROM m)",
        "p AS (SELECT feature, CASE WHEN strength > 0 THEN mean * strength ELSE 0 END AS a, CASE WHEN strength > 0 THEN (1 - mean) * strength ELSE 0 END AS b FROM s)") +
        """SELECT feature, key1, key2, clicks, exposures, round(a, 6) AS a, round(b, 6) AS b,
        round((clicks + a) / (exposures + a + b), 6) AS smoothed FROM rates JOIN p USING (feature)""",
    "ctr_gaps_filled": _with() + _own_rates_sql(ATTRIBUTE_AD, gap=0.0),
    "ctr_tokens": _with(_tokens_cte("t", "samples", TOKEN_COLUMNS, "uid, aid, label"),
        "r AS (SELECT feature, token, aid, sum(label) / count(*) AS rate FROM t WHERE token <> '-1' AND label <> -1 GROUP BY 1, 2, 3)") +
        "SELECT t.uid, t.aid, " + ", ".join(f"round(avg(rate) FILTER (t.feature = '{c}'), 6) AS {c}ctr" for c in TOKEN_COLUMNS) +
        " FROM t LEFT JOIN r ON r.feature = t.feature AND r.token = t.token AND r.aid = t.aid GROUP BY 1, 2",
    "ad_exposures": _with("e AS (SELECT aid, count(*) AS exposures FROM samples GROUP BY 1)") +
        "SELECT uid, aid, exposures FROM samples LEFT JOIN e USING (aid)",
    "history_rates": _with(_rates_cte({c: [c] for c in ("aid", "lbs", "advertiserid", "producttype")})) +
        _attached_sql({c: [c] for c in ("aid", "lbs", "advertiserid", "producttype")}),
    "combined_keys": _with() + _union(
        f"SELECT uid, aid, '{n}' AS feature, concat_ws(' ', {', '.join(cs)}) AS key FROM samples" for n, cs in COMBOS.items()),
    "combined_codes": _with(
        "wide AS (SELECT uid, aid, " + ", ".join(f"concat_ws(' ', {', '.join(cs)}) AS {n}" for n, cs in COMBOS.items()) + " FROM samples)",
        _codes_cte("codes", "wide", list(COMBOS))) + _coded_sql("wide", list(COMBOS)),
    "combination_counts": _with() + "SELECT uid, aid, " + ", ".join(
        f"count(*) OVER (PARTITION BY {', '.join(cs)}) AS {n}_n" for n, cs in COMBOS.items()) + " FROM samples",
    "pair_shares": _with("p AS (" + _union(
        f"SELECT '{a}_{u}' AS feature, {a} AS ad_value, {u} AS user_value, count(*) AS n FROM samples GROUP BY {a}, {u}"
        for a in AD_ATTRIBUTES for u in USER_ATTRIBUTES) + ")") +
        "SELECT feature, ad_value, user_value, n, round(n / sum(n) OVER (PARTITION BY feature, ad_value), 6) AS share FROM p",
    "widened_pairs": _with(_rates_cte({c: [c] for c in USER_ATTRIBUTES})) +
        _attached_sql({c: [c] for c in USER_ATTRIBUTES}).replace("_ctr", ""),
    "lookup_audit": _with() + _union([
        _audit_sql("parts", "SELECT p_partkey AS k, count(*) AS m FROM part GROUP BY 1", "aid"),
        _audit_sql("lines", "SELECT l_partkey AS k, count(*) AS m FROM lineitem GROUP BY 1", "aid"),
        _audit_sql("events", "SELECT user_id AS k, count(*) AS m FROM events GROUP BY 1", "uid")]),
    "auc_all": _auc_sql(_LINES),
    "auc_by_part": _auc_sql(_LINES, "part"),
    "best_f1_all": _f1_sql(_LINES),
    "best_f1_by_part": _f1_sql(_LINES, "part"),
    "feature_screen": _screen_sql(),
    "token_cut_search": _cut_sql(SAMPLES_SQL, "samples", "interest1"),
    "document_cut_search": _cut_curve_sql(DOCUMENTS_SQL, "docs", "text"),
}
