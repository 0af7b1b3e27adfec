"""``oracle_sql()``: DuckDB SQL for every ``queries()`` key.

The oracle sees only the driver's tables, so each string starts with the
fixture adapters as CTEs (the same rules as ``sources.fixtures``). The steps
are stated from their meaning (SURVEY section 2B) in forms of their own:
lookup tables of labels and tenure ranges, NOT EXISTS for the targetables,
counted multiplicities for the audience's repeated rows, an as-of join for the
daily status, EXISTS for returning viewers, grouped weights for the KPIs, and
Simpson's rule for the p-values. Doubles are rounded to 6 decimals at the end.
"""

from __future__ import annotations

import re

from ..functions import labels as L
from ..params import FIXTURE_PARAMS, Params
from ..sources import fixtures as FX

NY = "America/New_York"
# Simpson's rule: intervals of the normal tail (length 12) and of the t density's angle.
NORMAL_TAIL, NORMAL_STEPS, T_STEPS = 12.0, 2400, 20000


def _d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def _values(rows) -> str:
    cell = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + ")"


def _simpson(lo: str, hi: str, f, n: int) -> str:
    """Integral of f over [lo, hi] with n (even) intervals, as a list expression."""
    h = f"((({hi}) - ({lo})) / {float(n)})"
    weight = f"(CASE WHEN i = 0 OR i = {n} THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END)"
    return f"(list_sum(list_transform(range(0, {n + 1}), lambda i: {weight} * {f(f'(({lo}) + i * {h})')})) * {h} / 3.0)"


def _normal_p(z: str) -> str:
    a = f"abs({z})"
    tail = _simpson(a, f"{a} + {NORMAL_TAIL}", lambda x: f"exp(-{x} * {x} / 2.0)", NORMAL_STEPS)
    return f"(CASE WHEN {z} IS NOT NULL THEN least(1.0, {tail} * sqrt(2.0 / pi())) END)"


def _t_p(t: str, df: str) -> str:
    """Both tails: with t = sqrt(df) tan(x) the density is proportional to cos(x)^(df - 1)."""
    density = lambda x: f"pow(greatest(cos{x}, 0.0), {df} - 1.0)"
    tail = _simpson(f"atan(abs({t}) / sqrt({df}))", "pi() / 2.0", density, T_STEPS)
    whole = _simpson("0.0", "pi() / 2.0", density, T_STEPS)
    return f"(CASE WHEN {t} IS NOT NULL AND {df} > 0 THEN least(1.0, {tail} / {whole}) END)"


def _ctes(p: Params) -> list[tuple[str, str]]:
    thr = _d(p.tenure_threshold)
    aud_case = " ".join(f"WHEN {r} THEN '{n}'" for r, n in FX._AUDIENCE_BY_RESIDUE.items())
    base_ts = f"TIMESTAMP '{FX.OPTIN_BASE_UTC.isoformat(sep=' ')}'"
    optin = f"{base_ts} - to_days(CAST((7 * k) % {FX.OPTIN_SPREAD_DAYS} AS INTEGER))"
    ctes = [
        ("keys", "SELECT CAST(c_custkey AS BIGINT) AS k FROM customer"),
        ("account_view", f"""
            SELECT k AS householdid, {optin} AS targetedoptindate FROM keys WHERE k % 50 <> 49
            UNION ALL
            SELECT k, {optin} + INTERVAL {FX.OPTIN_SECOND_ROW_DAYS} DAY FROM keys
            WHERE k % 50 <> 49 AND k % 3 = 0"""),
        ("customer_keys", """
            SELECT k AS profileid, 'mp' || k AS externalprofilerid, 'mparticle' AS partnerorsystemid FROM keys
            UNION ALL SELECT k, 'mp' || k, 'mparticle' FROM keys WHERE k % 25 = 7
            UNION ALL SELECT k, 'aid' || k, 'trackingid' FROM keys WHERE k % 40 NOT IN (30, 39)
            UNION ALL SELECT k, 'aid' || k || 'b', 'trackingid' FROM keys WHERE k % 30 = 5"""),
    ]
    for t, r in FX.BACKFILL_RESIDUES.items():
        ctes.append((t, f"""
            SELECT 'mp' || k AS identity_value,
                   CASE WHEN k % 100 = {90 + r} THEN 'email' ELSE 'other_5' END AS identity_type
            FROM keys WHERE k % 10 = {r}"""))
    ctes += [
        ("audience_list", f"""
            SELECT 'mp' || k AS identityvalues_other_id_5, CASE k % 20 {aud_case} END AS audiencename
            FROM keys WHERE k % 20 IN ({', '.join(str(r) for r in FX._AUDIENCE_BY_RESIDUE)})"""),
        ("silver_video", """
            SELECT 'aid' || o.o_custkey AS adobe_tracking_id,
                   CAST(l.l_shipdate AS TIMESTAMP) AS adobe_timestamp,
                   CAST(l.l_shipdate AS DATE) AS adobe_date,
                   CASE WHEN l.l_orderkey % 17 = 0 THEN NULL
                        WHEN p.p_type = 'PROMO' THEN 'VOD_ShortForm' ELSE p.p_type END AS consumption_type,
                   p.p_name AS program,
                   CASE WHEN l.l_linenumber <= 6 THEN 1 ELSE 0 END AS num_views_started,
                   CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS num_views_completed,
                   CAST(l.l_quantity * 60 AS DOUBLE) AS num_seconds_played_no_ads
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                            JOIN part p ON l.l_partkey = p.p_partkey"""),
    ]
    control, social, display, braze = (L.holdout(c) for c in ("control", "paidsoc", "paiddis", "braze"))
    tags = [*zip(FX.BACKFILL_RESIDUES, (control, social, display, braze), strict=True), *L.AUDIENCE_LIST_NAMES.items()]
    blocked = [("control", x) for x in (control, social, display, L.BRAZE_EXCLUSION_LABEL)]
    blocked += [("paidsoc", control), ("paidsoc", social), ("paiddis", control), ("paiddis", display)]
    arms = [(c, L.targetable(c)) for c in ("control", "paidsoc", "paiddis")]
    ranges = [("FIRST_WEEK", 1, 1), ("SECOND_WEEK", 2, 2), ("THIRD_FOURTH_WEEK", 3, 4), ("SECOND_MONTH", 5, 7),
              ("THREE_PLUS_MONTHS", 8, 10**6)]
    lists = " UNION ALL ".join(f"SELECT '{t}' AS origin, identity_value AS ident, identity_type AS kind FROM {t}"
                               for t in FX.BACKFILL_RESIDUES)
    start = f"CAST({_d(p.campaign_start_period)} AS TIMESTAMP)"
    ctes += [
        # ---- audience ----
        ("tagged", f"""
            SELECT ident, kind, label FROM ({lists}
                   UNION ALL SELECT audiencename, identityvalues_other_id_5, 'other_5' FROM audience_list) l
            JOIN {_values(tags)} tag(origin, label) USING (origin)"""),
        ("holdout_groups", """
            SELECT ident AS identity_value, label AS audiencecohort FROM tagged
            WHERE kind = 'other_5' GROUP BY ident, label"""),
        ("household_signup", f"""
            SELECT householdid, min(day) AS signup_date
            FROM (SELECT householdid, CAST(timezone('{NY}', timezone('UTC', targetedoptindate)) AS DATE) AS day
                  FROM account_view) GROUP BY householdid"""),
        ("trackers", "SELECT profileid, externalprofilerid AS aid FROM customer_keys WHERE partnerorsystemid = 'trackingid'"),
        # an id on k mapping rows counts k times for each of them
        ("weighted_members", """
            SELECT profileid, externalprofilerid AS mparticleid,
                   count(*) * sum(count(*)) OVER (PARTITION BY externalprofilerid) AS times
            FROM customer_keys GROUP BY profileid, externalprofilerid"""),
        ("weighted_holdouts", f"""
            SELECT m.profileid, mparticleid, audiencecohort, aid, signup_date, times
            FROM household_signup s JOIN weighted_members m ON m.profileid = s.householdid AND s.signup_date < {thr}
            JOIN holdout_groups g ON g.identity_value = mparticleid
            LEFT JOIN trackers t ON t.profileid = m.profileid"""),
        ("holdout_users", """
            SELECT profileid, mparticleid, audiencecohort, aid, signup_date
            FROM weighted_holdouts, unnest(range(CAST(times AS BIGINT)))"""),
        ("free_households", f"""
            SELECT householdid, campaign, label
            FROM household_signup s, {_values(arms)} arm(campaign, label)
            WHERE signup_date < {thr}
              AND NOT EXISTS (FROM weighted_holdouts h JOIN {_values(blocked)} b(c, held) ON b.held = h.audiencecohort
                              WHERE b.c = campaign AND h.profileid = s.householdid)"""),
    ]
    for c, _ in arms:
        ctes.append((f"targetable_{c}", f"""
            SELECT householdid, label AS audiencecohort FROM free_households WHERE campaign = '{c}'"""))
    ctes += [
        ("targetable_master", "SELECT householdid AS profileid, label AS audiencecohort FROM free_households"),
        ("targetable_users", """
            SELECT profileid, aid, label AS audiencecohort
            FROM trackers JOIN free_households ON householdid = profileid"""),
        ("weighted_audience", f"""
            SELECT aid, profileid, audiencecohort, times FROM weighted_holdouts
            WHERE audiencecohort NOT IN ('{L.BRAZE_EXCLUSION_LABEL}')
            UNION ALL SELECT aid, profileid, audiencecohort, 1 FROM targetable_users"""),
        ("all_audience", """
            SELECT aid, profileid, audiencecohort FROM weighted_audience, unnest(range(CAST(times AS BIGINT)))"""),
        ("weighted_signup", """
            SELECT w.*, (SELECT signup_date FROM household_signup WHERE householdid = w.profileid) AS signup_date
            FROM weighted_audience w"""),
        ("audience_signup", """
            SELECT aid, profileid, audiencecohort, signup_date
            FROM weighted_signup, unnest(range(CAST(times AS BIGINT)))"""),
        ("adopter_group", f"""
            SELECT *, if(signup_date IS NULL, 'not_in_cohort', if(signup_date < {_d(p.campaign_start_date)}, 'pre', 'during'))
                      AS adopter_group FROM audience_signup"""),
        ("weighted_class", f"""
            SELECT a.*, r.name AS tenure_classification
            FROM weighted_signup a LEFT JOIN {_values(ranges)} r(name, lo, hi)
              ON ({_d(p.tenure_date)} - DATE '1899-12-31') // 7 - (signup_date - DATE '1899-12-31') // 7 BETWEEN lo AND hi"""),
        ("classification", """
            SELECT aid, profileid, audiencecohort, signup_date, tenure_classification
            FROM weighted_class, unnest(range(CAST(times AS BIGINT)))"""),
        ("members", """
            SELECT aid, audiencecohort, tenure_classification, sum(times) AS times, max(signup_date) AS signup_date
            FROM weighted_class WHERE aid IS NOT NULL GROUP BY ALL"""),
        ("audience_size", """
            SELECT audiencecohort, tenure_classification, sum(if(aid IS NULL, 0, 1))::BIGINT AS audience_size
            FROM (SELECT DISTINCT aid, audiencecohort, tenure_classification FROM weighted_class) GROUP BY 1, 2"""),
        # ---- engagement ----
        ("started", "SELECT * FROM silver_video WHERE num_views_started = 1"),
        ("title_normalisation", """
            SELECT *, if(contains(lower(coalesce(consumption_type, '')), 'shortform'), 'shortform', program) AS new_program
            FROM started"""),
        ("viewing", f"""
            SELECT adobe_tracking_id AS aid, len(list_distinct(list(new_program))) AS titles, count(*) AS starts,
                   sum(num_views_completed) AS completes, sum(num_seconds_played_no_ads) AS seconds
            FROM title_normalisation
            WHERE date_diff('second', {start}, adobe_timestamp) >= 0
              AND date_diff('second', {start} + to_days({p.window_days}), adobe_timestamp) < 0
            GROUP BY 1"""),
        ("viewers", """
            SELECT aid, audiencecohort, tenure_classification, titles AS distinct_titles,
                   CAST(starts * times AS BIGINT) AS content_starts, CAST(completes * times AS BIGINT) AS content_completed,
                   seconds * times / 3600 AS total_hours
            FROM members JOIN viewing USING (aid)"""),
        ("cohort_kpis", """
            SELECT v.*, z.audience_size FROM (
              SELECT audiencecohort, tenure_classification, count(*) AS conversions_watched_video,
                     avg(distinct_titles) AS repertoire, stddev_samp(distinct_titles) AS repertoire_stddev,
                     avg(content_starts) AS avg_starts, avg(total_hours) AS "usage",
                     stddev_samp(total_hours) AS usage_stdv,
                     sum(content_completed) / sum(content_starts) AS avg_completion_rate,
                     CAST(sum(content_starts) AS BIGINT) AS all_starts,
                     CAST(sum(content_completed) AS BIGINT) AS all_completes
              FROM viewers GROUP BY 1, 2) v
            JOIN audience_size z ON (v.audiencecohort, coalesce(v.tenure_classification, '-'))
                                  = (z.audiencecohort, coalesce(z.tenure_classification, '-'))"""),
        # ---- daily status, save and winback ----
        ("play_days", "SELECT DISTINCT adobe_tracking_id AS tracking_id, adobe_date AS day FROM started"),
        ("daily_last_view_status", f"""
            SELECT d.report_date, d.tracking_id, s.day AS most_recent_start
            FROM (SELECT CAST(unnest(range(CAST({_d(p.status_start)} AS TIMESTAMP),
                                           CAST({_d(p.status_end)} AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE)
                         AS report_date, tracking_id FROM (SELECT DISTINCT tracking_id FROM play_days)) d
            ASOF JOIN play_days s ON s.tracking_id = d.tracking_id AND s.day <= d.report_date"""),
        ("gaps", f"""
            SELECT *, abs(report_date - most_recent_start) AS gap FROM daily_last_view_status
            WHERE report_date >= {_d(p.launch_date)}"""),
        ("lapsing_save", f"""
            SELECT report_date, tracking_id, most_recent_start FROM gaps
            WHERE gap >= {p.save_gap_min} AND gap < {p.save_gap_max + 1}
              AND report_date >= {_d(p.save_report_start)} AND report_date <= {_d(p.save_report_end)}"""),
        ("lapsing_winback", f"""
            SELECT report_date, tracking_id, most_recent_start FROM gaps
            WHERE gap >= {p.winback_gap_min} AND report_date <= {_d(p.winback_report_end)}"""),
        ("returning_save", f"""
            SELECT tracking_id AS adobe_tracking_id FROM (SELECT DISTINCT tracking_id FROM lapsing_save) v
            WHERE EXISTS (FROM lapsing_save l JOIN play_days d USING (tracking_id)
                          WHERE l.tracking_id = v.tracking_id
                            AND l.most_recent_start >= {_d(p.save_report_start)}
                            AND l.most_recent_start <= {_d(p.save_report_end)}
                            AND d.day - l.most_recent_start IN ({', '.join(map(str, range(p.save_gap_min, p.save_gap_max + 1)))}))"""),
        ("returning_winback", f"""
            SELECT tracking_id AS adobe_tracking_id
            FROM (SELECT tracking_id, min(most_recent_start) AS since FROM lapsing_winback GROUP BY 1) v
            WHERE EXISTS (FROM play_days d WHERE d.tracking_id = v.tracking_id AND d.day - v.since >= {p.winback_gap_min}
                          AND d.day >= {_d(p.winback_report_start)} AND d.day <= {_d(p.winback_report_end)})"""),
    ]
    for what, denom, num, bounds in (
        ("save", "save_rate_denom", "saves", f"signup_date >= {_d(p.save_signup_floor)}"),
        ("winback", "winback_rate_denom", "winbacks",
         f"signup_date >= {_d(p.winback_signup_floor)} AND signup_date <= {_d(p.winback_signup_ceiling)}"),
    ):
        ctes.append((f"{what}_rate", f"""
            SELECT audiencecohort, tenure_classification, count(*) AS {denom}, count(back) AS {num},
                   count(back) / count(*) AS {what}_rate
            FROM (SELECT DISTINCT aid, audiencecohort, tenure_classification FROM weighted_class
                  WHERE {bounds} AND aid IN (SELECT tracking_id FROM lapsing_{what}))
            LEFT JOIN (SELECT adobe_tracking_id AS aid, 1 AS back FROM returning_{what}) USING (aid)
            GROUP BY 1, 2"""))
    # ---- labelled reports (the notebook's formatting) ----
    label_cols = f"""
            CASE split_part(audiencecohort, '_', 2) WHEN 'paiddis' THEN '{L.DISPLAY_PAID_DISPLAY}'
                 WHEN 'paidsoc' THEN '{L.DISPLAY_PAID_SOCIAL}' ELSE '{L.DISPLAY_ALL_PAID}' END AS cohort,
            CASE WHEN split_part(audiencecohort, '_', 1) = '{L.TARGETABLE_ARM}' THEN '{L.DISPLAY_TARGETABLE}'
                 ELSE '{L.DISPLAY_HOLDOUT}' END AS targetable"""
    for name, src in (("lab_kpi", "cohort_kpis"), ("lab_save", "save_rate"), ("lab_winback", "winback_rate")):
        ctes.append((name, f"""
            SELECT *, {label_cols} FROM {src}
            WHERE audiencecohort IS DISTINCT FROM '{L.BRAZE_LABEL}'"""))
    for name, src in (("pair_kpi", "lab_kpi"), ("pair_save", "lab_save"), ("pair_winback", "lab_winback")):
        ctes.append((name, f"""
            SELECT t.cohort, t.tenure_classification, t AS t, h AS h
            FROM (SELECT * FROM {src} WHERE targetable = '{L.DISPLAY_TARGETABLE}') t
            JOIN (SELECT * FROM {src} WHERE targetable <> '{L.DISPLAY_TARGETABLE}') h
              ON t.cohort = h.cohort AND t.tenure_classification = h.tenure_classification"""))
    for stat, sd in (("repertoire", "repertoire_stddev"), ("usage", "usage_stdv")):
        ctes.append((f"tt_{stat}", f"""
            SELECT cohort, tenure_classification, df,
                   CASE WHEN se <> 0 THEN (m1 - m2) / se END AS t
            FROM (SELECT *, sqrt(pv * (1.0 / n1 + 1.0 / n2)) AS se
                  FROM (SELECT *, CASE WHEN df <> 0 THEN ((n1 - 1) * s1 * s1 + (n2 - 1) * s2 * s2) / df END AS pv
                        FROM (SELECT cohort, tenure_classification,
                                     (t).{stat} AS m1, (h).{stat} AS m2,
                                     (t).{sd} AS s1, (h).{sd} AS s2,
                                     CAST((t).audience_size AS DOUBLE) AS n1,
                                     CAST((h).audience_size AS DOUBLE) AS n2,
                                     CAST((t).audience_size + (h).audience_size - 2 AS DOUBLE) AS df
                              FROM pair_kpi)))"""))
        ctes.append((f"tp_{stat}", f"""
            SELECT *, {_t_p('t', 'df')} AS p_value FROM tt_{stat}"""))
    for name, src, cnt, nobs in (("conv", "pair_kpi", "conversions_watched_video", "audience_size"),
                                 ("save", "pair_save", "saves", "save_rate_denom"),
                                 ("winback", "pair_winback", "winbacks", "winback_rate_denom")):
        ctes.append((f"zz_{name}", f"""
            SELECT cohort, tenure_classification,
                   CASE WHEN var <> 0 THEN (x1 / n1 - x2 / n2) / sqrt(var) END AS z
            FROM (SELECT *, pp * (1.0 - pp) * (1.0 / n1 + 1.0 / n2) AS var
                  FROM (SELECT *, (x1 + x2) / (n1 + n2) AS pp
                        FROM (SELECT cohort, tenure_classification,
                                     CAST((t).{cnt} AS DOUBLE) AS x1, CAST((h).{cnt} AS DOUBLE) AS x2,
                                     CAST((t).{nobs} AS DOUBLE) AS n1, CAST((h).{nobs} AS DOUBLE) AS n2
                              FROM {src})))"""))
        ctes.append((f"zp_{name}", f"""
            SELECT *, {_normal_p('z')} AS p_value FROM zz_{name}"""))
    return ctes


def _flag(p: str, alpha: float) -> str:
    return f"CASE WHEN {p} >= {alpha} THEN 'No' ELSE 'Yes' END"


def _r(c: str) -> str:
    return f'round({c}, 6) AS "{c}"'


def _finals(p: Params) -> dict[str, str]:
    a = p.alpha
    kpi_d = ["repertoire", "repertoire_stddev", "avg_starts", "usage", "usage_stdv", "avg_completion_rate"]
    kpi_cols = ", ".join(["audiencecohort", "tenure_classification", "conversions_watched_video",
                          *[_r(c) for c in kpi_d], "all_starts", "all_completes", "audience_size"])
    rep_d = ["avg_completion_rate", "avg_starts", "repertoire", "usage", "usage_stdv"]
    t_fin = {
        stat: f"""SELECT cohort, tenure_classification, round(t, 6) AS t, round(df, 6) AS df,
                  round(p_value, 6) AS p_value, {_flag('p_value', a)} AS {stat}_significance
                  FROM tp_{stat}"""
        for stat in ("repertoire", "usage")
    }
    z_fin = {
        name: f"""SELECT cohort, tenure_classification, round(z, 6) AS z, round(p_value, 6) AS p_value,
                  {_flag('p_value', a)} AS {cnt}_significance FROM zp_{name}"""
        for name, cnt in (("conv", "conversions_watched_video"), ("save", "saves"), ("winback", "winbacks"))
    }
    save_sel = f"SELECT audiencecohort, tenure_classification, save_rate_denom, saves, {_r('save_rate')} FROM save_rate"
    wb_sel = ("SELECT audiencecohort, tenure_classification, winback_rate_denom, winbacks, "
              f"{_r('winback_rate')} FROM winback_rate")
    return {
        "holdout_groups": "SELECT * FROM holdout_groups",
        "household_signup": "SELECT * FROM household_signup",
        "holdout_users": "SELECT * FROM holdout_users",
        "targetable_control": "SELECT * FROM targetable_control",
        "targetable_paidsoc": "SELECT * FROM targetable_paidsoc",
        "targetable_paiddis": "SELECT * FROM targetable_paiddis",
        "targetable_master": "SELECT * FROM targetable_master",
        "targetable_users": "SELECT * FROM targetable_users",
        "all_audience": "SELECT * FROM all_audience",
        "audience_signup": "SELECT * FROM audience_signup",
        "adopter_group": "SELECT * FROM adopter_group",
        "tenure_classification": "SELECT * FROM classification",
        "audience_size": "SELECT * FROM audience_size",
        "title_normalisation": "SELECT * FROM title_normalisation",
        "viewer_stats": "SELECT * REPLACE (round(total_hours, 6) AS total_hours) FROM viewers",
        "cohort_kpis": f"SELECT {kpi_cols} FROM cohort_kpis",
        "daily_last_view": "SELECT * FROM daily_last_view_status",
        "daily_last_view_incremental": "SELECT * FROM daily_last_view_status",
        "last_view_ranges": """SELECT tracking_id, most_recent_start, min(report_date) AS since, max(report_date) AS until
                  FROM daily_last_view_status GROUP BY 1, 2""",
        "audience_losses": """
            SELECT 'holdout_ids_without_profile' AS metric, count(DISTINCT identity_value) AS n_rows FROM holdout_groups
            WHERE identity_value NOT IN (SELECT externalprofilerid FROM customer_keys)
            UNION ALL SELECT 'holdout_rows_without_tracking_id', count(*) FROM holdout_users WHERE aid IS NULL
            UNION ALL SELECT 'targetable_rows_without_tracking_id', count(*) FROM targetable_master m
            WHERE NOT EXISTS (FROM trackers t WHERE t.profileid = m.profileid)
            UNION ALL SELECT 'audience_rows_multiplied',
                   count(*) - (SELECT count(*) FROM (SELECT DISTINCT profileid, audiencecohort, aid FROM all_audience)) FROM all_audience
            UNION ALL SELECT 'audience_rows_without_signup', count(*) FROM audience_signup WHERE signup_date IS NULL""",
        "lapsing_save": "SELECT * FROM lapsing_save",
        "returning_save": "SELECT * FROM returning_save",
        "save_rate": save_sel,
        "lapsing_winback": "SELECT * FROM lapsing_winback",
        "returning_winback": "SELECT * FROM returning_winback",
        "winback_rate": wb_sel,
        "kpi_report": f"""SELECT cohort, targetable, tenure_classification, all_completes, all_starts,
                  audience_size, audiencecohort, {', '.join(_r(c) for c in rep_d[:3])},
                  conversions_watched_video, round(repertoire_stddev, 6) AS repertoire_stdv,
                  {', '.join(_r(c) for c in rep_d[3:])}
                  FROM lab_kpi ORDER BY cohort, tenure_classification NULLS LAST, targetable""",
        "save_report": f"""SELECT cohort, targetable, tenure_classification, saves, save_rate_denom,
                  {_r('save_rate')} FROM lab_save ORDER BY cohort, tenure_classification NULLS LAST, targetable""",
        "winback_report": f"""SELECT cohort, targetable, tenure_classification, winbacks, winback_rate_denom,
                  {_r('winback_rate')} FROM lab_winback
                  ORDER BY cohort, tenure_classification NULLS LAST, targetable""",
        "repertoire_significance": t_fin["repertoire"],
        "usage_significance": t_fin["usage"],
        "engagement_significance": f"""SELECT r.cohort, r.tenure_classification,
                  {_flag('r.p_value', a)} AS repertoire_significance, {_flag('u.p_value', a)} AS usage_significance
                  FROM tp_repertoire r JOIN tp_usage u
                    ON r.cohort = u.cohort AND r.tenure_classification = u.tenure_classification""",
        "conversion_significance": z_fin["conv"],
        "save_significance": z_fin["save"],
        "winback_significance": z_fin["winback"],
        "csv_roundtrip_general": f"SELECT {kpi_cols} FROM cohort_kpis",
        "csv_roundtrip_save": save_sel,
        "csv_roundtrip_winback": wb_sel,
    }


def _assemble(ctes: list[tuple[str, str]], final: str) -> str:
    """WITH-clause holding only the CTEs ``final`` needs (transitively)."""
    names = [n for n, _ in ctes]
    body = dict(ctes)

    def refs(sql: str) -> set[str]:
        return {n for n in names if re.search(rf"\b{n}\b", sql)}

    need: set[str] = set()
    todo = list(refs(final))
    while todo:
        n = todo.pop()
        if n not in need:
            need.add(n)
            todo.extend(refs(body[n]) - need)
    parts = [f"{n} AS ({body[n].strip()})" for n in names if n in need]
    return "WITH " + ",\n".join(parts) + "\n" + final.strip()


def build_oracle(params: Params = FIXTURE_PARAMS) -> dict[str, str]:
    ctes = _ctes(params)
    finals = _finals(params)
    out = {k: _assemble(ctes, v) for k, v in finals.items()}
    # parameter variants
    no_tenure = params.replace(tenure_days=0)
    out["holdout_users_no_tenure"] = _assemble(_ctes(no_tenure), "SELECT * FROM holdout_users")
    from .registry import CUSTOM_WINDOW

    out["cohort_kpis_custom_window"] = _assemble(_ctes(CUSTOM_WINDOW), _finals(CUSTOM_WINDOW)["cohort_kpis"])
    return out
