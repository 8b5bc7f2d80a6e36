"""SQL for the derived tables of ``workload.tables``, as common table expressions."""

DATED = """dated AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
         nullif(o_orderstatus, 'P') AS status,
         CAST(year(o_orderdate) AS DOUBLE) AS y,
         CAST(month(o_orderdate) AS DOUBLE) AS m,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS days
  FROM orders)"""

VISITS = """visits AS (
  SELECT CAST(o_orderkey AS DOUBLE) AS cicid,
         CAST(year(o_orderdate) AS DOUBLE) AS i94yr,
         CAST(month(o_orderdate) AS DOUBLE) AS i94mon,
         CAST(c_nationkey AS DOUBLE) AS i94cit,
         CAST(o_custkey % 30 AS DOUBLE) AS i94res,
         CAST(day AS DOUBLE) AS arrdate,
         CAST(nullif(substr(o_orderpriority, 1, 1), '5') AS DOUBLE) AS i94mode,
         CAST(CASE WHEN o_orderstatus <> 'O' THEN day + length(o_orderpriority) END AS DOUBLE) AS depdate,
         floor(o_totalprice / 5000) AS i94bir,
         CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS DOUBLE) AS i94visa,
         CAST(1 AS DOUBLE) AS "count",
         CAST(year(o_orderdate) - floor(o_totalprice / 5000) AS DOUBLE) AS biryear,
         round(o_totalprice * 100) * 1000 AS admnum,
         substr(c_mktsegment, 1, 3) AS i94port,
         nullif(substr(o_orderpriority, 3, 2), 'LO') AS i94addr,
         strftime(date, '%Y%m%d') AS dtadfile,
         substr(c_mktsegment, 1, 3) AS visapost,
         CAST(NULL AS VARCHAR) AS occup,
         o_orderstatus AS entdepa,
         nullif(o_orderstatus, 'O') AS entdepd,
         CAST(NULL AS VARCHAR) AS entdepu,
         CASE WHEN o_orderstatus <> 'O' THEN 'M' END AS matflag,
         strftime(date + 180, '%m%d%Y') AS dtaddto,
         CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'P' THEN 'M' END AS gender,
         CAST(NULL AS VARCHAR) AS insnum,
         substr(c_mktsegment, 1, 2) AS airline,
         lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS fltno,
         o_orderstatus || substr(o_orderpriority, 1, 1) AS visatype
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS date,
               date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS day
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey))"""

LOOKUPS = """addr AS (
  SELECT DISTINCT substr(o_orderpriority, 3, 2) AS key, substr(o_orderpriority, 3) AS value
  FROM orders WHERE substr(o_orderpriority, 1, 1) <> '2'),
cntyl AS (
  SELECT CAST(n_nationkey AS VARCHAR) || CASE WHEN n_nationkey = 24 THEN 'x' ELSE '' END AS key,
         n_name AS value
  FROM nation WHERE n_regionkey <> 2),
mode AS (
  SELECT DISTINCT substr(o_orderpriority, 1, 1) AS key, substr(o_orderpriority, 3) AS value
  FROM orders WHERE substr(o_orderpriority, 1, 1) <> '3'),
port AS (
  SELECT DISTINCT substr(c_mktsegment, 1, 3) AS key, c_mktsegment AS value FROM customer),
visa AS (
  SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END AS key,
         'STATE ' || o_orderstatus AS value
  FROM orders)"""


def enriched(partition_type: str = "INTEGER") -> str:
    """The enriched table; its partition columns are ints once written to a lake."""
    return f"""{VISITS},
{LOOKUPS},
enriched AS (
  SELECT CAST(CAST(i94yr AS INTEGER) AS VARCHAR) || '-'
           || lpad(CAST(CAST(i94mon AS INTEGER) AS VARCHAR), 2, '0') || '-'
           || CAST(CAST(cicid AS BIGINT) AS VARCHAR) AS guid,
         CAST(i94yr AS {partition_type}) AS i94yr,
         CAST(i94mon AS {partition_type}) AS i94mon,
         cicid,
         DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS arrival_date,
         DATE '1960-01-01' + CAST(depdate AS INTEGER) AS departure_date,
         i94addr, addr.value AS i94addr_value,
         i94cit, cit.value AS i94cit_value,
         i94res, res.value AS i94res_value,
         i94mode, mode.value AS i94mode_value,
         i94port, port.value AS i94port_value,
         i94visa, visa.value AS i94visa_value,
         visatype, visapost, gender, biryear, i94bir, occup, admnum, insnum, entdepa,
         entdepd, entdepu, matflag, dtadfile, dtaddto, airline, fltno, arrdate, depdate
  FROM visits
  LEFT JOIN addr ON i94addr = addr.key
  LEFT JOIN cntyl AS cit ON i94cit = TRY_CAST(cit.key AS DOUBLE)
  LEFT JOIN cntyl AS res ON i94res = TRY_CAST(res.key AS DOUBLE)
  LEFT JOIN mode ON i94mode = TRY_CAST(mode.key AS DOUBLE)
  LEFT JOIN port ON i94port = port.key
  LEFT JOIN visa ON i94visa = TRY_CAST(visa.key AS DOUBLE))"""
