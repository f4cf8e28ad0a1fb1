"""SQL twins of the bindings, as common table expressions for the oracles."""

CUR = """
cur_base AS (
  SELECT *, CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'DiscountedUsage' WHEN 'AO' THEN 'SavingsPlanRecurringFee'
      WHEN 'RF' THEN 'RIFee' WHEN 'RO' THEN 'EdpDiscount' WHEN 'NO' THEN 'Usage' ELSE 'SavingsPlanCoveredUsage' END AS kind,
    CASE p_type WHEN 'SMALL' THEN 'BoxUsage' WHEN 'MEDIUM' THEN 'SpotUsage' WHEN 'LARGE' THEN 'DataTransfer-Out-Bytes'
      WHEN 'STANDARD' THEN 'EBS:VolumeUsage' WHEN 'PROMO' THEN 'EBSOptimized:BoxUsage' ELSE 'TimedStorage-ByteHrs' END AS utype,
    CASE p_size % 5 WHEN 0 THEN 'm5.large' WHEN 1 THEN 'c5n.large' WHEN 2 THEN 'r6gd.large' WHEN 3 THEN 'db.m5.large' ELSE '' END AS itype,
    cast(l_shipdate AS DATE) AS day, l_extendedprice AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
cur AS (
  SELECT *, (kind = 'SavingsPlanRecurringFee' AND l_tax = 0) AS unbilled,
    cast(year(day) AS VARCHAR) AS y, cast(month(day) AS VARCHAR) AS m,
    CASE WHEN kind = 'SavingsPlanRecurringFee' AND l_tax = 0 THEN 0.0 ELSE price END AS unblended,
    CASE WHEN kind = 'SavingsPlanRecurringFee' AND l_tax = 0 THEN 0.0 ELSE price * 0.5 END AS net_unblended,
    CASE WHEN l_linenumber = 7 THEN 'Marketplace' ELSE 'AWS' END AS entity,
    CASE WHEN l_linenumber = 6 THEN 'i-parent' ELSE '' END AS split_parent,
    CASE WHEN p_size % 3 = 0 THEN '' ELSE 'Amazon' || p_type END AS servicecode,
    CASE WHEN p_size % 2 = 0 THEN 'Amazon Elastic Compute Cloud' ELSE '' END AS servicename,
    CASE WHEN l_linenumber = 5 THEN 'prod' ELSE '' END AS cluster,
    CASE WHEN l_partkey % 3 = 0 THEN '' ELSE p_brand END AS project,
    CASE WHEN l_suppkey % 4 <> 0 THEN 'srv-' || l_suppkey ELSE '' END AS tagname,
    CASE WHEN p_size % 4 = 0 THEN cast(p_size AS DOUBLE) ELSE p_size * 0.5 END AS mem_gib,
    CASE WHEN p_size % 7 = 1 THEN 1.0 END AS gpu
  FROM cur_base)
"""

COST = CUR + """,
std AS (
  SELECT y AS year, m AS month, date_trunc('month', day)::DATE AS date, kind AS charge_type, itype AS it, cluster,
    cast(s_nationkey AS VARCHAR) AS usage_account, 'region-' || (s_nationkey % 5) AS region, utype AS usage_type,
    'charge ' || l_linestatus AS description, 'i-' || l_suppkey AS resource_id, project,
    CASE WHEN entity = 'AWS' THEN 'AWS' ELSE 'Reseller' END AS billing_entity,
    CASE WHEN split_parent <> '' THEN 'AmazonEC2' WHEN servicecode <> '' THEN servicecode WHEN entity = 'AWS' THEN p_brand ELSE p_name END AS service,
    CASE WHEN split_parent <> '' THEN 'AmazonEC2' WHEN entity = 'AWS' THEN p_brand ELSE p_name END AS product,
    CASE WHEN p_size > 45 THEN 'MySQL' ELSE '' END AS engine,
    sum(l_quantity) AS usage_amount,
    sum(CASE WHEN kind LIKE '%Usage' AND utype NOT LIKE '%EBSOptimized%' THEN p_size * l_quantity ELSE 0 END) AS vcpus,
    sum(CASE WHEN kind LIKE '%Usage' AND utype NOT LIKE '%EBSOptimized%' THEN gpu * l_quantity ELSE 0 END) AS gpus,
    sum(CASE WHEN kind LIKE '%Usage' AND utype NOT LIKE '%EBSOptimized%' THEN mem_gib * l_quantity ELSE 0 END) AS memory_gb,
    sum(CASE kind WHEN 'EdpDiscount' THEN 0 WHEN 'DiscountedUsage' THEN price * (1 + l_tax) WHEN 'Usage' THEN unblended
      WHEN 'SavingsPlanCoveredUsage' THEN price * (1 + l_tax) WHEN 'RIFee' THEN price * 0.1 + price * 0.2
      WHEN 'SavingsPlanRecurringFee' THEN price * 0.4 + price * 0.5 - price * 0.4 END) AS ondemand_cost,
    sum(CASE kind WHEN 'EdpDiscount' THEN 0 WHEN 'DiscountedUsage' THEN price * (1 - l_discount) WHEN 'Usage' THEN unblended
      WHEN 'SavingsPlanCoveredUsage' THEN price * 0.6 WHEN 'RIFee' THEN price * 0.1 + price * 0.2
      WHEN 'SavingsPlanRecurringFee' THEN price * 0.4 + price * 0.5 - price * 0.4 END) AS amortized_cost,
    sum(CASE kind WHEN 'EdpDiscount' THEN 0 WHEN 'DiscountedUsage' THEN price * 0.5 WHEN 'Usage' THEN net_unblended
      WHEN 'SavingsPlanCoveredUsage' THEN price * 0.5 WHEN 'RIFee' THEN price * 0.05 + price * 0.15
      WHEN 'SavingsPlanRecurringFee' THEN (price * 0.4 + price * 0.5 - price * 0.4)
        * CASE WHEN unblended = 0 THEN (price * 0.4) / (price * 0.4) ELSE net_unblended / unblended END END) AS net_amortized_cost,
    sum(unblended) AS billing_cost
  FROM cur GROUP BY ALL)
"""

METRICS = """
pods AS (
  SELECT cast(year(l_shipdate) AS VARCHAR) AS year, cast(month(l_shipdate) AS VARCHAR) AS month,
    date_trunc('month', l_shipdate)::DATE AS date, cast(s_nationkey AS VARCHAR) AS usage_account,
    'region-' || (s_nationkey % 5) AS region, 'i-' || l_suppkey AS instance, 'prod' AS cluster,
    'ns-' || (l_partkey % 10) AS ns, 'app-' || (l_partkey % 100) AS app, 'i-' || l_suppkey || ':pod/prod/' || l_partkey AS pod_id,
    sum(l_quantity) AS cpu, sum(l_extendedprice * 1000000.0) / 1073741824.0 AS mem, sum(l_quantity) + sum(l_extendedprice) AS net
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
"""

TAGGED = """
tagged AS (
  SELECT date_trunc('month', l_shipdate)::DATE AS date, CASE WHEN l_partkey % 3 = 0 THEN '' ELSE p_brand END AS t1,
    CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE p_type END AS t2, CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE l_linestatus END AS t3,
    l_returnflag AS charge_type, sum(l_extendedprice) AS od, sum(l_extendedprice * (1 - l_discount)) AS am,
    sum(l_extendedprice * 0.5) AS ne,
    sum(CASE WHEN l_returnflag = 'R' AND l_linenumber = 3 THEN l_extendedprice * -0.25 ELSE l_extendedprice END) AS bi
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
"""

SAMPLES = """
samples AS (
  SELECT event_id, 'r-' || user_id AS resource_id, event_type AS metric, cast(floor(epoch(ts)) AS BIGINT) AS epoch, ts, user_id, value, props
  FROM events)
"""
