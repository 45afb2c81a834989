"""The url query as SQL."""

from __future__ import annotations

from collections.abc import Sequence

from riskloom.llm import url_filter
from riskloom.llm.common import LOWER, UPPER


def url_sql(rules: Sequence[tuple[str, str]], order: int = 3) -> str:
    """What `url_filter.url_verdicts` gives, without the score, over a view `pages`."""
    cases = {"rule": "", "said": ""}
    for rule, said in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        host, slash, rest = rule.partition("/")
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{rest}')"
        cases["rule"] += f" WHEN {fits} THEN '{rule}'"
        cases["said"] += f" WHEN {fits} THEN '{said}'"
    joins, p = "", f"1e0 / {url_filter.ALPHABET}"
    for k in range(order + 1):
        p = f"(coalesce(g{k}.n, 0) + {url_filter.BACK_OFF}e0 * ({p})) / (coalesce(c{k}.n, 0) + {url_filter.BACK_OFF}e0)"
        joins += f"""
  LEFT JOIN of_gram g{k} ON g{k}.fit = b.fit AND g{k}.side = b.side AND g{k}.k = {k} AND g{k}.tail = right(b.gram, {k + 1})
  LEFT JOIN of_context c{k} ON c{k}.fit = b.fit AND c{k}.side = b.side AND c{k}.k = {k} AND c{k}.context = left(right(b.gram, {k + 1}), {k})"""
    lower = f"translate({{}}, '{UPPER}', '{LOWER}')"
    rest = lower.format("regexp_replace(url, '^(?s:.*?)://', '')")
    grams = f"unnest(list_transform(range(1, length(chars) + 2), lambda i: substring('{'^' * order}' || chars || '$', i, {order + 1})))"
    step = url_filter.STEP
    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
h AS (SELECT page_id, {lower.format("regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1)")} AS host,
  regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path,
  regexp_replace(translate({rest}, '123456789', '000000000'), '[^a-z0./\\-_?=&#%]', '~', 'g') AS chars FROM u),
r AS (SELECT *, CASE{cases["rule"]} END AS rule, CASE{cases["said"]} END AS said,
  ('0x' || substr(md5(chars), 1, 8))::BIGINT % 2 AS half FROM h),
examples AS (SELECT 'whole' AS fit, said AS side, chars FROM r WHERE said IS NOT NULL
  UNION ALL SELECT 'trial', said, chars FROM r WHERE said IS NOT NULL AND half = 0),
counts AS (SELECT fit, side, gram, count(*) AS n FROM (SELECT fit, side, {grams} AS gram FROM examples) GROUP BY ALL),
orders AS (SELECT unnest(range(0, {order + 1})) AS k),
of_gram AS (SELECT fit, side, k, right(gram, k + 1) AS tail, sum(n) AS n FROM counts, orders GROUP BY ALL),
of_context AS (SELECT fit, side, k, left(right(gram, k + 1), k) AS context, sum(n) AS n FROM counts, orders GROUP BY ALL),
texts AS (SELECT DISTINCT chars FROM r WHERE chars <> ''),
places AS (SELECT chars, {grams} AS gram FROM texts),
b AS (SELECT * FROM (SELECT DISTINCT gram FROM places), (VALUES ('whole'), ('trial')) f(fit), (VALUES ('allow'), ('block')) s(side)),
logs AS (SELECT b.fit, b.side, b.gram, ln({p}) AS l FROM b{joins}),
ratios AS (SELECT x.fit, x.gram, x.l - y.l AS ratio FROM logs x JOIN logs y ON x.fit = y.fit AND x.gram = y.gram AND x.side = 'allow' AND y.side = 'block'),
scores AS (SELECT fit, chars, avg(ratio) AS score FROM places JOIN ratios USING (gram) GROUP BY ALL),
trial AS (SELECT DISTINCT chars, said, coalesce(score, 0) AS score FROM r LEFT JOIN (SELECT * FROM scores WHERE fit = 'trial') USING (chars) WHERE said IS NOT NULL AND half = 1),
steps AS (SELECT CAST(floor(greatest(-10e0, least(10e0, score)) / {step}) AS BIGINT) AS step,
  count(CASE WHEN said = 'allow' THEN 1 END) AS good, count(CASE WHEN said = 'block' THEN 1 END) AS bad FROM trial GROUP BY 1),
cuts AS (SELECT step, sum(good) OVER () AS all_good, sum(bad) OVER () AS all_bad, coalesce(lag(step) OVER w + 1, step) AS last_step,
  sum(good) OVER w - good AS below_good, sum(bad) OVER w - bad AS below_bad FROM steps WINDOW w AS (ORDER BY step)),
best AS (SELECT (last_step + step) / 2e0 * {step} AS threshold FROM cuts WHERE all_good > 0 AND all_bad > 0
  ORDER BY (all_good - below_good) / CAST(all_good AS DOUBLE) + below_bad / CAST(all_bad AS DOUBLE) DESC, step LIMIT 1)
SELECT page_id, host, path, rule,
  coalesce(said, CASE WHEN coalesce(score, 0) >= coalesce((SELECT threshold FROM best), 0) THEN 'allow' ELSE 'block' END) AS verdict
FROM r LEFT JOIN (SELECT * FROM scores WHERE fit = 'whole') USING (chars)
"""
