"""The derived views in SQL, so that each query can be checked by another engine on the same tables."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "person": """
SELECT c_custkey AS person_id,
       split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name,
       CAST(CAST(c_acctbal AS DECIMAL(10,2)) + 1000 AS DECIMAL(10,2)) AS balance
FROM customer""",
    "product": """
SELECT p_partkey AS product_id,
       p_name || '#' || CAST(p_partkey AS VARCHAR) AS code,
       p_brand || ' ' || p_type AS description,
       CAST(CAST(p_size AS DECIMAL(10,2)) + 0.99 AS DECIMAL(10,2)) AS price
FROM part""",
    "inventory": """
SELECT p_partkey + 1 AS inventory_id, p_partkey AS product_id, 20 + p_partkey % 30 AS qty
FROM part WHERE p_partkey % 50 <> 49""",
    "request": """
SELECT event_id AS request_id,
       user_id AS person_id,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS product_id,
       1 + event_id % 5 AS qty,
       CAST(CASE WHEN event_type IN ('click', 'purchase', 'view') THEN 10
                 WHEN event_type = 'signup' THEN 20
                 WHEN event_id % 2 = 0 THEN 99
                 ELSE 30 END AS INTEGER) AS operation,
       CAST(CASE event_id % 10 WHEN 7 THEN 20 WHEN 8 THEN 30 WHEN 9 THEN 99 ELSE 10 END AS INTEGER) AS result,
       ts
FROM events""",
    "routed": """
SELECT 'requests' AS topic,
       CAST(product_id % 8 AS INTEGER) AS partition_id,
       row_number() OVER (PARTITION BY product_id % 8 ORDER BY request_id) - 1 AS offset_id,
       CAST(product_id AS VARCHAR) AS msg_key,
       CASE WHEN request_id % 101 = 0 THEN '{broken'
            ELSE '{"requestId":' || CAST(request_id AS VARCHAR) || ',"personId":' || CAST(person_id AS VARCHAR)
              || ',"productId":' || CAST(product_id AS VARCHAR) || ',"qty":' || CAST(qty AS VARCHAR)
              || ',"operation":' || CAST(operation AS VARCHAR) || ',"result":' || CAST(result AS VARCHAR) || '}'
       END AS msg_value,
       request_id, person_id, product_id, qty, operation, result, request_id % 101 = 0 AS broken, ts
FROM request
WHERE result IN (10, 20)""",
    "record": "SELECT topic, partition_id, offset_id, msg_key, msg_value, request_id, ts FROM routed",
    "delivered": """
SELECT *, 1 AS attempt FROM routed
UNION ALL
SELECT *, 2 AS attempt FROM routed WHERE request_id % 13 = 0""",
    "log_end": """
SELECT topic, partition_id, max(offset_id) + 1 AS end_offset FROM record GROUP BY topic, partition_id""",
    "consumer_group": """
SELECT 'group-' || CAST(c_custkey AS VARCHAR) AS group_id,
       CASE c_custkey % 10 WHEN 3 THEN 'SHARE' WHEN 5 THEN NULL ELSE 'CONSUMER' END AS group_type
FROM customer""",
    "threshold": """
SELECT 'group-' || CAST(c_custkey AS VARCHAR) AS group_id, c_custkey % 5 * 10 AS threshold
FROM customer WHERE c_custkey % 4 <> 0""",
    "committed": """
SELECT 'group-' || CAST(person_id AS VARCHAR) AS group_id, topic, partition_id,
       max(offset_id) + 1 + CASE WHEN person_id % 7 = 0 THEN 100000 ELSE 0 END AS committed_offset
FROM routed GROUP BY person_id, topic, partition_id
UNION ALL
SELECT DISTINCT 'group-' || CAST(person_id AS VARCHAR), 'audit', 0, 5 FROM routed WHERE person_id % 11 = 0""",
    "lag_rows": """
SELECT c.group_id, c.topic, c.partition_id, c.committed_offset,
       coalesce(e.end_offset, c.committed_offset) AS end_offset,
       greatest(coalesce(e.end_offset, c.committed_offset) - c.committed_offset, 0) AS lag
FROM committed c LEFT JOIN log_end e USING (topic, partition_id)""",
    "topic_name": """
SELECT DISTINCT CASE event_id % 5 WHEN 0 THEN '__consumer_offsets'
                                  WHEN 1 THEN '__transaction_state-' || event_type
                                  WHEN 2 THEN '_schemas'
                                  WHEN 3 THEN 'orders-' || event_type
                                  ELSE '_audit-' || event_type END AS topic
FROM events""",
    "priced": """
SELECT r.request_id, r.person_id, r.product_id, r.qty, r.operation, i.inventory_id, i.qty AS stock, p.price, c.balance,
       i.qty IS NOT NULL AND p.price IS NOT NULL AND c.balance IS NOT NULL AS parents_found,
       CASE WHEN i.qty IS NOT NULL AND c.balance IS NOT NULL
            THEN CAST(p.price * r.qty AS DECIMAL(18,2)) END AS cost
FROM request r
LEFT JOIN inventory i USING (product_id)
LEFT JOIN product p USING (product_id)
LEFT JOIN person c USING (person_id)
WHERE r.result IN (10, 20)""",
    "queue": """
SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY request_id) AS rn
FROM priced WHERE parents_found AND operation IN (10, 20)""",
    "fold": """
SELECT product_id, request_id, qty, operation, stock AS met, rn,
       operation = 20 OR stock >= qty AS ok,
       CASE WHEN operation = 20 THEN stock + qty WHEN stock >= qty THEN stock - qty ELSE stock END AS state
FROM queue WHERE rn = 1
UNION ALL
SELECT q.product_id, q.request_id, q.qty, q.operation, f.state, q.rn,
       q.operation = 20 OR f.state >= q.qty,
       CASE WHEN q.operation = 20 THEN f.state + q.qty WHEN f.state >= q.qty THEN f.state - q.qty ELSE f.state END
FROM fold f JOIN queue q ON q.product_id = f.product_id AND q.rn = f.rn + 1""",
    "stock_only": """
SELECT r.request_id, r.product_id, r.qty, r.operation,
       CASE WHEN r.result NOT IN (10, 20) THEN r.result WHEN f.request_id IS NULL THEN 99
            WHEN f.ok THEN 30 ELSE 20 END AS result,
       CASE WHEN NOT f.ok THEN 'stock' END AS reason,
       f.met AS stock_before
FROM request r LEFT JOIN fold f USING (request_id)""",
    "stock_after": """
SELECT i.inventory_id, i.product_id, CAST(i.qty + coalesce(m.delta, 0) AS BIGINT) AS qty
FROM inventory i LEFT JOIN (
  SELECT product_id, sum(CASE WHEN NOT ok THEN 0 WHEN operation = 10 THEN -qty ELSE qty END) AS delta
  FROM fold GROUP BY product_id) m USING (product_id)""",
    # One request after the other, with all stocks and balances carried along as lists.
    "line_up": """
SELECT request_id, qty, operation, cost, stock, balance,
       row_number() OVER (ORDER BY request_id) AS n,
       dense_rank() OVER (ORDER BY product_id) AS g, dense_rank() OVER (ORDER BY person_id) AS p
FROM queue""",
    "opening": """
SELECT 0 AS n, CAST(NULL AS BIGINT) AS s, CAST(NULL AS DECIMAL(18,2)) AS b,
       (SELECT list(CAST(stock AS BIGINT) ORDER BY g) FROM (SELECT DISTINCT g, stock FROM line_up)) AS stocks,
       (SELECT list(CAST(balance AS DECIMAL(18,2)) ORDER BY p) FROM (SELECT DISTINCT p, balance FROM line_up)) AS balances""",
    "serial": """
SELECT * FROM opening
UNION ALL
SELECT n, s, b,
       CASE WHEN ok THEN stocks[:g-1] || [s + sign * qty] || stocks[g+1:] ELSE stocks END,
       CASE WHEN ok THEN balances[:p-1] || [CAST(b + sign * cost AS DECIMAL(18,2))] || balances[p+1:] ELSE balances END
FROM (SELECT l.*, stocks, balances, stocks[l.g] AS s, balances[l.p] AS b,
             CASE WHEN l.operation = 10 THEN -1 ELSE 1 END AS sign,
             l.operation = 20 OR (stocks[l.g] >= l.qty AND balances[l.p] >= l.cost) AS ok
      FROM serial v JOIN line_up l ON l.n = v.n + 1)""",
    "allocated": """
SELECT r.request_id, r.person_id, r.product_id, r.qty, r.operation,
       CASE WHEN r.result NOT IN (10, 20) THEN r.result WHEN d.n IS NULL THEN 99 WHEN s_ok AND b_ok THEN 30 ELSE 20 END AS result,
       CASE WHEN NOT s_ok THEN 'stock' WHEN NOT b_ok THEN 'balance' END AS reason,
       d.cost, d.s AS stock_before, d.b AS balance_before
FROM request r LEFT JOIN (
  SELECT l.*, v.s, v.b, l.operation = 20 OR v.s >= l.qty AS s_ok, l.operation = 20 OR v.b >= l.cost AS b_ok
  FROM serial v JOIN line_up l USING (n)) d USING (request_id)""",
    "product_change": """
SELECT product_id, code, description, CAST(price + 1 AS DECIMAL(10,2)) AS price
FROM product WHERE product_id % 5 = 0
UNION ALL
SELECT product_id + 10000000, code, description, price FROM product WHERE product_id % 7 = 0""",
    "product_next": """
SELECT p.product_id, p.code, p.description, coalesce(c.price, p.price) AS price
FROM product p LEFT JOIN product_change c USING (product_id)""",
}

_RECURSIVE = {"fold", "serial"}


def _needs(sql: str) -> set[str]:
    return {name for name in VIEWS if re.search(rf"\b{name}\b", sql)}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it names, directly or through another view, in definition order."""
    wanted, open_names = set(), _needs(sql)
    while open_names:
        name = open_names.pop()
        if name not in wanted:
            wanted.add(name)
            open_names |= _needs(VIEWS[name])
    if not wanted:
        return sql
    head = "WITH RECURSIVE " if wanted & _RECURSIVE or "RECURSIVE" in sql else "WITH "
    return head + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in wanted) + "\n" + sql
