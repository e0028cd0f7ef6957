"""The fixture relations as DuckDB SQL (common table expressions).

These restate, independently of the Spark code, how the driver tables map
to DNS answers, observations, certificates, providers and the seen state.
A query's oracle is `with_(...)` followed by its SELECT.
"""

from __future__ import annotations

DNS_ROWS = r"""dns_rows AS (
SELECT event_id AS off, epoch_us(ts) // 1000 AS ts, domain, half, topic, qtype,
       CASE WHEN kk % 4 <> 0 THEN domain
            ELSE concat('ns', CAST(event_id % 2 + 1 AS VARCHAR), '.', host) END AS qname,
       CASE qtype WHEN 'A' THEN concat('10.0.', CAST(user_id % 5 AS VARCHAR), '.', CAST(kk % 7 AS VARCHAR))
                  WHEN 'AAAA' THEN concat('2001:db8::', CAST(kk % 7 AS VARCHAR)) END AS ip,
       CASE WHEN qtype = 'NS' THEN concat('ns', CAST(kk % 2 + 1 AS VARCHAR), '.', host) END AS ns,
       CASE WHEN qtype = 'MX' THEN concat('mx', CAST(kk % 3 AS VARCHAR), '.mail', CAST(user_id % 4 AS VARCHAR), '.com') END AS mx,
       CASE WHEN qtype = 'MX' THEN CAST((kk % 3) * 10 AS BIGINT) END AS pref,
       CASE WHEN kk % 10 = 9 THEN 3 ELSE 0 END AS rcode,
       CAST(300 * (1 + event_id % 4) AS BIGINT) AS ttl,
       concat('645', CAST((user_id + CASE WHEN half = 'now' AND user_id % 5 = 0 THEN 1 ELSE 0 END) % 6 AS VARCHAR),
              CAST(event_id % 2 AS VARCHAR)) AS asn,
       CASE event_id % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'NL' WHEN 2 THEN 'DE' ELSE 'CN' END AS cc,
       value AS rtt
FROM (SELECT *, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS kk,
             CASE user_id % 6 WHEN 0 THEN 'parkone.com' WHEN 1 THEN 'cust.parktwo.net' WHEN 2 THEN 'dualpark.com'
                  WHEN 3 THEN 'dualpark.net' WHEN 4 THEN 'bigdns.io' ELSE 'otherdns.org' END AS host,
             concat('d', CAST(user_id AS VARCHAR), CASE user_id % 3 WHEN 0 THEN '.com' WHEN 1 THEN '.net' ELSE '.io' END) AS domain,
             CASE event_id % 3 WHEN 0 THEN 'domains' WHEN 1 THEN 'fqdn' ELSE 'certs' END AS topic,
             CASE event_type WHEN 'click' THEN 'A' WHEN 'view' THEN 'AAAA' WHEN 'purchase' THEN 'NS' WHEN 'signup' THEN 'MX' ELSE 'TXT' END AS qtype,
             CASE WHEN ts < DATE '2024-01-16' THEN 'prev' ELSE 'now' END AS half
      FROM events) e)"""

# kind and keyed columns of each usable answer
KEYED = r"""keyed AS (
SELECT *, CASE WHEN qtype IN ('A', 'AAAA') AND qname = domain THEN 'ip' WHEN qtype IN ('A', 'AAAA') THEN 'ns_ip'
               WHEN qtype = 'NS' AND qname = domain THEN 'ns' WHEN qtype = 'MX' AND qname = domain THEN 'mx' END AS k
FROM dns_rows)"""

OBS = r"""obs AS (
SELECT half, k, topic, d, s, m, q, ip,
       CASE WHEN k IN ('ip', 'ns_ip') THEN arg_min(asn, off) END AS a,
       CASE WHEN k IN ('ip', 'ns_ip') THEN arg_min(cc, off) END AS c,
       CAST(NULL AS VARCHAR) AS p, CAST(pref AS BIGINT) AS pr,
       CAST(arg_min(ttl, off) AS BIGINT) AS tl, CAST(min(ts) AS BIGINT) AS fs, CAST(max(ts) AS BIGINT) AS ls,
       CAST(count(*) AS BIGINT) AS n, CAST(NULLIF(rcode, 0) AS BIGINT) AS rc
FROM (SELECT half, off, ts, topic, rcode, asn, cc, ttl, ip, pref, k,
             CASE WHEN qname = domain THEN domain END AS d,
             CASE WHEN qtype IN ('A', 'AAAA') AND qname <> domain THEN qname WHEN qtype = 'NS' THEN ns END AS s,
             mx AS m, CASE WHEN qtype IN ('A', 'AAAA') THEN qtype END AS q
      FROM keyed) x
WHERE k IS NOT NULL
GROUP BY half, k, topic, d, s, m, q, ip, pref, rcode)"""

# messages of many answers: one per domain, topic and day, newest answer first, in three partitions
MESSAGES = r"""dated AS (SELECT *, ts // 86400000 AS day FROM keyed),
messages AS (
SELECT * EXCLUDE (ts, asn), ts AS at, CASE WHEN off % 11 <> 0 THEN ts END AS ts, CASE WHEN off % 7 <> 0 THEN asn END AS asn,
       max(ts) OVER same AS broker_ms,
       (min(off) OVER same % 3) * 1000000000000000 + (min(off) OVER same // 3) * 100000
         + row_number() OVER (PARTITION BY domain, topic, day, half ORDER BY off DESC) AS arrival
FROM dated WINDOW same AS (PARTITION BY domain, topic, day, half))"""


def message_rollup(window: str) -> str:
    """The rollup of `messages` per `window`: attributes of the first arrival, its NULLs included."""
    return f"""rolled AS (
SELECT {window}, k, topic, d, s, m, q, ip, f.a, f.c, CAST(NULL AS VARCHAR) AS p, CAST(pref AS BIGINT) AS pr, CAST(f.tl AS BIGINT) AS tl,
       CAST(fs AS BIGINT) AS fs, CAST(ls AS BIGINT) AS ls, CAST(n AS BIGINT) AS n, CAST(NULLIF(rcode, 0) AS BIGINT) AS rc
FROM (SELECT {window}, k, topic, d, s, m, q, ip, pref, rcode, min(ts) AS fs, max(ts) AS ls, count(*) AS n,
             arg_min({{'a': CASE WHEN k IN ('ip', 'ns_ip') THEN asn END, 'c': CASE WHEN k IN ('ip', 'ns_ip') THEN cc END, 'tl': ttl}},
                     arrival) AS f
      FROM (SELECT *, (broker_ms // 43200000 + 1) * 43200000 AS window_end_ms,
                   CASE WHEN qname = domain THEN domain END AS d,
                   CASE WHEN qtype IN ('A', 'AAAA') AND qname <> domain THEN qname WHEN qtype = 'NS' THEN ns END AS s,
                   mx AS m, CASE WHEN qtype IN ('A', 'AAAA') THEN qtype END AS q
            FROM messages WHERE k IS NOT NULL)
      GROUP BY {window}, k, topic, d, s, m, q, ip, pref, rcode))"""


CERT_NAMES = r"""cert_names AS (
SELECT off AS certIndex, concat('log', CAST(off % 4 AS VARCHAR)) AS source, md5(CAST(off AS VARCHAR)) AS fingerprint, half,
       domain AS name FROM dns_rows WHERE qtype = 'AAAA'
UNION ALL
SELECT off, concat('log', CAST(off % 4 AS VARCHAR)), md5(CAST(off AS VARCHAR)), half,
       concat('www.', domain) FROM dns_rows WHERE qtype = 'AAAA'
UNION ALL
SELECT off, concat('log', CAST(off % 4 AS VARCHAR)), md5(CAST(off AS VARCHAR)), half,
       concat('*.', upper(domain), '.') FROM dns_rows WHERE qtype = 'AAAA')"""

PROVIDERS_VALUES = r"""SELECT * FROM (VALUES ('park_a', '.parkone.com', true), ('park_b', '.parktwo.net', true),
  ('park_dual', '.dualpark.com', true), ('park_dual', '.dualpark.net', true), ('park_none', '.nowhere.example', true),
  ('watch_c', '.bigdns.io', false)) AS p(provider, suffix, active)"""

PROVIDERS = f"providers AS (\n{PROVIDERS_VALUES})"

SEEN = r"""seen AS (
SELECT provider, domain, 'snap-' || strftime(epoch_ms((first_ms // 43200000 + 1) * 43200000), '%Y-%m-%d-%H') AS first_snap,
       first_ms
FROM (SELECT p.provider, o.d AS domain, CAST(min(o.fs) AS BIGINT) AS first_ms
      FROM obs o JOIN providers p ON ends_with(o.s, p.suffix)
      WHERE o.k = 'ns' AND o.half = 'prev' AND p.active
      GROUP BY p.provider, o.d) x
WHERE first_ms < 1704240000000)"""

def last_two_labels(x: str) -> str:
    """The last two dot-separated labels of a name (all of a shorter one)."""
    return f"regexp_extract({x}, '[^.]*(?:\\.[^.]*)?$')"


def apex_sql(x: str) -> str:
    """Registered domain of a name: lower case, no trailing dots, last two labels."""
    return last_two_labels(f"lower(rtrim({x}, '.'))")


def sorted_set(x: str, where: str = "") -> str:
    """Distinct values, sorted and comma-joined; NULL without any."""
    return f"string_agg(DISTINCT {x}, ',' ORDER BY {x})" + (f" FILTER (WHERE {where})" if where else "")


def audit_sql(rows: str, k: int) -> str:
    """Common table expressions that end in `audit`: the k apexes with the most domains.  `rows`: a
    query with d and s.  Domains are numbered inside their apex, so the samples are the first five."""
    return f"""named AS (SELECT {last_two_labels('s')} AS apex, d, s FROM ({rows})),
numbered AS (SELECT apex, d, row_number() OVER (PARTITION BY apex ORDER BY d) AS nth FROM (SELECT apex, d FROM named GROUP BY apex, d)),
by_domain AS (SELECT apex, max(nth) AS new_domains, string_agg(d, ',' ORDER BY nth) FILTER (WHERE nth <= 5) AS sample_domains
              FROM numbered GROUP BY apex),
by_host AS (SELECT apex, count(*) AS distinct_ns_hosts, min(s) AS sample_ns_host FROM (SELECT DISTINCT apex, s FROM named) GROUP BY apex),
audit AS (SELECT apex AS ns_apex, new_domains, distinct_ns_hosts, sample_ns_host, sample_domains
          FROM by_domain JOIN by_host USING (apex)
          QUALIFY row_number() OVER (ORDER BY new_domains DESC, apex) <= {k})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


OBS_CTES = (DNS_ROWS, KEYED, OBS)

# the catalogue and the audit read the files of one topic (registered domains)
PINNED = "pinned AS (SELECT * FROM obs WHERE topic = 'domains')"
