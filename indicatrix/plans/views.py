"""SQL texts of the views that the checking SQL reads, each after the ones it mentions."""

_NAME = "concat('d', CAST({} AS VARCHAR), '.com')"

VIEWS: dict[str, str] = {
    "feed_url": """
        SELECT page_id, url, lower(regexp_extract(url, '^https?://([^:/?#]*)', 1)) AS domain,
          CASE page_id % 3 WHEN 0 THEN 'urlhaus' WHEN 1 THEN 'openphish' ELSE 'benign_seed' END AS source,
          CASE page_id % 3 WHEN 0 THEN 'malware_download' WHEN 1 THEN 'phishing' ELSE 'benign' END AS label,
          CAST(concat('2024-01-', lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0'), ' 00:00:00') AS TIMESTAMP) AS first_seen
        FROM pages""",
    "label_row": f"""
        SELECT {_NAME.format('o_orderkey % 6500')} AS domain,
          concat('https://', {_NAME.format('o_orderkey % 6500')}, '/', CAST(o_custkey AS VARCHAR)) AS url,
          o_orderdate AS first_seen, CAST(o_orderdate AS DATE) AS ingest_date, o_orderpriority AS label,
          CASE o_orderkey % 3 WHEN 0 THEN 'urlhaus' WHEN 1 THEN 'openphish' ELSE 'benign_seed' END AS source
        FROM orders""",
    "supplier_ip": """
        SELECT s_suppkey, s_name, s_nationkey,
          CASE WHEN s_suppkey % 5 = 0 THEN concat('2001:db8::', CAST(s_suppkey AS VARCHAR))
               ELSE concat('10.0.', CAST(s_nationkey AS VARCHAR), '.', CAST(s_suppkey % 250 AS VARCHAR)) END AS ip,
          CASE WHEN s_suppkey % 5 = 0 THEN 6 ELSE 4 END AS family
        FROM supplier""",
    "dns_geo": f"""
        SELECT {_NAME.format('o.o_orderkey % 5000')} AS puny_domain, s.ip, s.family, n.n_name AS country,
          concat('AS', CAST(64512 + n.n_nationkey AS VARCHAR)) AS asn, s.s_name AS isp
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
          JOIN supplier_ip s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "whois": f"""
        SELECT {_NAME.format('o_orderkey % 6000')} AS domain, o_orderkey, o_orderpriority AS registrar,
          o_orderstatus AS status, o_orderdate AS created, o_orderdate + INTERVAL '3650' DAY AS expires,
          CASE WHEN o_orderkey % 11 = 0 THEN 'timeout' ELSE NULL END AS error,
          TIMESTAMP '2024-02-01 00:00:00' - INTERVAL '1' DAY * CAST(o_orderkey % 60 AS INT) AS fetched_at
        FROM orders""",
    "misp_attr": f"""
        SELECT event_id, ts AS first_seen, event_type AS category,
          CASE event_type WHEN 'error' THEN 'domain' WHEN 'signup' THEN 'hostname' WHEN 'click' THEN 'sha256' WHEN 'view' THEN 'email-src' ELSE 'url' END AS type,
          {_NAME.format('event_id * 3')} AS indicator
        FROM events
        UNION ALL
        SELECT 1000000 + s_suppkey, TIMESTAMP '2024-01-15 00:00:00', 'network',
          CASE WHEN s_suppkey % 2 = 0 THEN 'ip-src' ELSE 'ip-dst' END,
          concat_ws('.', '10', CAST(s_suppkey % 33 AS VARCHAR), CAST(s_nationkey AS VARCHAR), CAST(s_suppkey % 250 AS VARCHAR))
        FROM supplier""",
    "stream_event": """
        SELECT event_id, ts,
          CASE WHEN event_id % 17 = 0 THEN concat('{"id":"', CAST(event_id AS VARCHAR))
               WHEN event_id % 19 = 0 THEN concat('{"id":', CAST(event_id AS VARCHAR), ',"domain":"x.com"}')
               ELSE concat('{"id":"', CAST(event_id AS VARCHAR), '","domain":"d', CAST(user_id AS VARCHAR),
                 '.com","tld":null,"event_ts":"2024-01-01T00:00:00Z","source":"', event_type,
                 '","producer_ts":"2024-01-01T00:00:00Z"}') END AS value
        FROM events""",
    "scored": """
        SELECT d.doc_id, d.source, d.lang, l.quality AS label,
          CAST((d.n_chars * 7919) % 1000 AS DOUBLE) / 1000 AS score
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "scored_domain": f"""
        SELECT DISTINCT {_NAME.format('o_orderkey % 6500')} AS registered_domain,
          CAST((o_orderkey % 6500) * 7919 % 1000 AS DOUBLE) / 1000 AS score
        FROM orders""",
    # Results of operators that other checks build on, said in SQL's own way.
    "label_pick": """
        SELECT domain AS registered_domain, first_seen, source, url, label, domain, last_first_seen FROM (
          SELECT *, row_number() OVER (PARTITION BY domain ORDER BY first_seen, source, url, label) AS rn,
            max(first_seen) OVER (PARTITION BY domain) AS last_first_seen
          FROM label_row) WHERE rn = 1""",
    "listed_ip": """
        SELECT DISTINCT trim(indicator) AS ip FROM misp_attr WHERE type IN ('ip-src', 'ip-dst')""",
    "listed_domain": """
        SELECT registered_domain, category FROM (
          SELECT indicator AS registered_domain, category, row_number() OVER (
            PARTITION BY indicator ORDER BY first_seen DESC, event_id DESC, category) AS rn
          FROM misp_attr WHERE type IN ('domain', 'hostname', 'url')) WHERE rn = 1""",
    "dns_agg": """
        SELECT puny_domain AS registered_domain, count(DISTINCT ip) AS num_unique_ips,
          CAST(max(CASE WHEN family = 6 THEN 1 ELSE 0 END) AS INTEGER) AS has_ipv6,
          count(DISTINCT country) AS num_countries, count(DISTINCT asn) AS num_asns,
          first(asn ORDER BY ip, asn) FILTER (WHERE asn IS NOT NULL) AS sample_asn,
          first(isp ORDER BY ip, isp) FILTER (WHERE isp IS NOT NULL) AS sample_isp,
          first(country ORDER BY ip, country) FILTER (WHERE country IS NOT NULL) AS sample_country
        FROM dns_geo GROUP BY puny_domain""",
    "dns_hit": """
        SELECT puny_domain AS registered_domain, bool_or(ip IN (SELECT ip FROM listed_ip)) AS matched_misp_ip
        FROM dns_geo GROUP BY puny_domain""",
    "whois_pick": """
        SELECT domain AS registered_domain, registrar, status,
          epoch_us(TIMESTAMP '2024-02-01 00:00:00' - created) / 86400e6 AS age_days,
          epoch_us(expires - TIMESTAMP '2024-02-01 00:00:00') / 86400e6 AS days_to_expiry,
          CAST(created IS NULL AS INTEGER) AS created_isnull, CAST(expires IS NULL AS INTEGER) AS expires_isnull,
          CAST(error IS NOT NULL AS INTEGER) AS has_error
        FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY fetched_at DESC NULLS LAST,
            registrar NULLS FIRST, status NULLS FIRST, created NULLS FIRST, expires NULLS FIRST, error NULLS FIRST) AS rn
          FROM whois) WHERE rn = 1""",
    "feature_row": """
        SELECT l.registered_domain, l.first_seen, l.source, l.url, l.domain, l.last_first_seen,
          CASE WHEN l.source = 'benign_seed' THEN 0 ELSE 1 END AS label, l.label AS label_text,
          d.num_unique_ips, d.has_ipv6, d.num_countries, d.num_asns, d.sample_asn, d.sample_isp, d.sample_country,
          w.registrar, w.status, w.age_days, w.days_to_expiry, w.created_isnull, w.expires_isnull, w.has_error,
          coalesce(h.matched_misp_ip, false) AS matched_misp_ip, m.category,
          CASE WHEN m.category IS NOT NULL OR coalesce(h.matched_misp_ip, false) THEN 1 ELSE 0 END AS is_in_misp
        FROM label_pick l LEFT JOIN dns_agg d USING (registered_domain) LEFT JOIN whois_pick w USING (registered_domain)
          LEFT JOIN dns_hit h USING (registered_domain) LEFT JOIN listed_domain m USING (registered_domain)""",
    "threat_row": """
        SELECT f.domain, coalesce(f.url, '') AS url, concat(strftime(f.first_seen, '%Y-%m-%d %H:%M:%S'), '+00:00') AS "firstSeen",
          f.label_text AS label, CASE WHEN is_in_misp = 1 THEN 'misp_osint' ELSE f.source END AS source,
          CASE WHEN is_in_misp = 1 THEN 1.0 ELSE round(s.score, 4) END AS "riskScore",
          CASE WHEN is_in_misp = 1 OR s.score >= 0.9 THEN 'CRITICAL' WHEN s.score >= 0.6 THEN 'HIGH'
               WHEN s.score >= 0.2 THEN 'MEDIUM' ELSE 'LOW' END AS "riskLevel",
          CASE WHEN category IS NOT NULL THEN lower(category)
               WHEN matched_misp_ip THEN 'network infrastructure overlap'
               WHEN f.source = 'urlhaus' THEN 'malware' WHEN f.source = 'openphish' THEN 'phishing'
               ELSE 'suspicious' END AS "threatType",
          coalesce(sample_country, 'Unknown') AS country, coalesce(registrar, 'Unknown') AS registrar,
          CASE WHEN age_days IS NULL THEN -1 ELSE CAST(trunc(age_days) AS INTEGER) END AS "domainAgeDays"
        FROM feature_row f JOIN scored_domain s USING (registered_domain)""",
    "exported": """
        SELECT * FROM threat_row ORDER BY "riskScore" DESC, domain, url LIMIT 5000""",
    "curve": """
        SELECT g.*, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fp,
          sum(p) OVER () AS tp_all, sum(n) OVER () AS fp_all
        FROM (SELECT score, sum(label) AS p, count(*) - sum(label) AS n FROM scored GROUP BY score) g""",
}
