"""The derived fixture tables as DuckDB SQL, inlined as CTEs by each oracle query.

They state the same derivations as ``terrane.sources.fixtures`` in plain SQL.
"""

from __future__ import annotations

PARCELS = """
slots AS (
  SELECT o_orderkey // 4 AS pk, MIN(o_custkey) AS custkey,
    MAX(CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 23 <> 0 THEN CAST(o_orderdate AS DATE) END) AS recdate1,
    MAX(CASE WHEN o_orderkey % 4 = 0 THEN CASE WHEN o_orderstatus = 'P' THEN 0.0 WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE o_totalprice / 10000.0 END END) AS docfee1,
    MAX(CASE WHEN o_orderkey % 4 = 1 AND o_orderkey % 23 <> 0 THEN CAST(o_orderdate AS DATE) END) AS recdate2,
    MAX(CASE WHEN o_orderkey % 4 = 1 THEN CASE WHEN o_orderstatus = 'P' THEN 0.0 WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE o_totalprice / 10000.0 END END) AS docfee2,
    MAX(CASE WHEN o_orderkey % 4 = 2 AND o_orderkey % 23 <> 0 THEN CAST(o_orderdate AS DATE) END) AS recdate3,
    MAX(CASE WHEN o_orderkey % 4 = 2 THEN CASE WHEN o_orderstatus = 'P' THEN 0.0 WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE o_totalprice / 10000.0 END END) AS docfee3,
    MAX(CASE WHEN o_orderkey % 4 = 3 AND o_orderkey % 23 <> 0 THEN CAST(o_orderdate AS DATE) END) AS recdate4,
    MAX(CASE WHEN o_orderkey % 4 = 3 THEN CASE WHEN o_orderstatus = 'P' THEN 0.0 WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE o_totalprice / 10000.0 END END) AS docfee4
  FROM orders GROUP BY 1),
parcels AS (
SELECT CAST(s.pk AS VARCHAR(20)) AS schno,
  s.recdate1, s.docfee1, s.recdate2, s.docfee2, s.recdate3, s.docfee3, s.recdate4, s.docfee4,
  CAST(s.pk * 37 % 4001 AS DOUBLE) AS sfla,
  CAST(1890 + s.pk * 7 % 135 AS INT) AS year_blt,
  CAST(1890 + s.pk * 7 % 135 + CASE WHEN s.pk % 5 = 0 THEN 20 ELSE 0 END AS INT) AS adj_year_blt,
  CAST(CASE WHEN s.pk % 11 = 0 THEN NULL ELSE 1 + s.pk % 3 END AS INT) AS units,
  concat(c.c_name, ' ', CAST(s.pk AS VARCHAR)) AS address,
  CASE c.c_nationkey % 7 WHEN 0 THEN 'BRECKENRIDGE' WHEN 1 THEN 'FRISCO' WHEN 2 THEN 'DENVER' WHEN 3 THEN 'DALLAS' WHEN 4 THEN 'KEYSTONE' WHEN 5 THEN 'BOULDER' ELSE 'MIAMI' END AS city,
  CASE c.c_nationkey % 7 WHEN 3 THEN 'TX' WHEN 6 THEN NULL ELSE 'CO' END AS state,
  CAST(NULL AS VARCHAR) AS zip_code,
  CASE c.c_nationkey % 12 WHEN 0 THEN 'B' WHEN 1 THEN 'F' WHEN 2 THEN 'D' WHEN 3 THEN 'S' WHEN 4 THEN 'K' WHEN 5 THEN 'C' WHEN 6 THEN 'M' WHEN 7 THEN 'R' WHEN 8 THEN 'BR' WHEN 9 THEN 'H' WHEN 10 THEN 'None' ELSE 'ZZ' END AS town,
  CASE s.pk % 6 WHEN 0 THEN '1212' WHEN 1 THEN '1230' WHEN 2 THEN '1231' WHEN 3 THEN '1214' WHEN 4 THEN '100' ELSE NULL END AS abst1,
  CASE s.pk % 10 WHEN 0 THEN '1212' WHEN 1 THEN '0' ELSE NULL END AS abst2,
  CAST(s.pk % 6 AS DOUBLE) AS beds, CAST(s.pk % 9 AS DOUBLE) / 2.0 AS bath_tot,
  CASE WHEN s.pk % 4 <> 0 THEN CAST(s.pk % 3 * 240 AS DOUBLE) END AS garage_size,
  CASE WHEN s.pk % 5 <> 0 THEN CAST(s.pk % 16 AS DOUBLE) / 8.0 END AS lot_size,
  CASE s.pk % 9 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'D' WHEN 4 THEN 'E' WHEN 5 THEN 'F' WHEN 6 THEN 'X' WHEN 7 THEN 'Q' END AS grade,
  CASE s.pk % 7 WHEN 0 THEN 'B' WHEN 1 THEN 'C' WHEN 2 THEN 'F' WHEN 3 THEN '?' END AS cond,
  CASE WHEN s.pk % 8 < 6 THEN CAST(s.pk % 2 AS INT) END AS scenic_view
FROM slots s LEFT JOIN customer c ON c.c_custkey = s.custkey)"""

RAW_TEXT = """
raw_text AS (
SELECT CASE WHEN CAST(schno AS INT) % 211 = 0 THEN NULL ELSE schno END AS schno,
  CASE WHEN CAST(schno AS INT) % 53 = 0 THEN 'NOT A DATE'
       WHEN CAST(schno AS INT) % 7 = 0 THEN concat(CAST(month(recdate1) AS VARCHAR(4)), '/', CAST(day(recdate1) AS VARCHAR(4)), '/', CAST(year(recdate1) AS VARCHAR(4)), ' 9:13:25 AM')
       ELSE concat(CAST(month(recdate1) AS VARCHAR(4)), '/', CAST(day(recdate1) AS VARCHAR(4)), '/', CAST(year(recdate1) AS VARCHAR(4))) END AS recdate1,
  CASE WHEN CAST(schno AS INT) % 31 = 0 THEN 'n/a' WHEN CAST(schno AS INT) % 29 = 0 THEN '  25.50  ' WHEN CAST(schno AS INT) % 37 = 0 THEN '1_000' WHEN CAST(schno AS INT) % 41 = 0 THEN '12d' WHEN CAST(schno AS INT) % 43 = 0 THEN '0x1p3' ELSE CAST(CAST(schno AS INT) % 90 AS VARCHAR(20)) END AS docfee1,
  CASE WHEN CAST(schno AS INT) % 61 = 0 THEN '9999' WHEN CAST(schno AS INT) % 67 = 0 THEN '1995.5' ELSE CAST(year_blt AS VARCHAR(4)) END AS year_blt,
  CASE WHEN CAST(schno AS INT) % 97 = 0 THEN 'abc' WHEN CAST(schno AS INT) % 89 = 0 THEN '2005.0' ELSE CAST(adj_year_blt AS VARCHAR(4)) END AS adj_year_blt,
  CAST(units AS VARCHAR(4)) AS units,
  CASE WHEN CAST(schno AS INT) % 101 = 0 THEN 'two' WHEN CAST(schno AS INT) % 103 = 0 THEN '2f' ELSE CAST(CAST(beds AS INT) AS VARCHAR(4)) END AS beds
FROM parcels)"""

OWNERS = """
owners AS (
SELECT schno, concat(CASE stem % 4 WHEN 0 THEN 'PATRICK ' WHEN 1 THEN 'JONES ' WHEN 2 THEN 'Vincent ' ELSE 'ADAMS ' END,
   CAST(stem AS VARCHAR),
   CASE stem % 8 WHEN 1 THEN ' LLC' WHEN 3 THEN ' FAMILY TRUST' WHEN 5 THEN ' CHURCH' WHEN 7 THEN ' LTD' ELSE '' END) AS primary_owner
FROM (SELECT schno, CASE WHEN CAST(schno AS INT) % 5 = 0 THEN CAST(schno AS INT) // 100 * 2 ELSE CAST(schno AS INT) // 3 * 2 + 1 END AS stem
  FROM parcels WHERE CAST(schno AS INT) % 50 <> 0) o)"""

ADDRESS_POINTS = """
address_points AS (
SELECT concat(schno, '.0') AS property_schedule,
  39.45 + CAST(CAST(schno AS INT) * 13 % 200 AS DOUBLE) / 1000.0 AS latitude,
  -106.20 + CAST(CAST(schno AS INT) * 17 % 330 AS DOUBLE) / 1000.0 AS longitude, address AS full_address
FROM parcels WHERE CAST(schno AS INT) % 9 <> 0)"""

MACRO = """
macro AS (
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, round(AVG(l_discount) * 100, 6) AS value FROM lineitem GROUP BY 1)"""

SCRAPED = """
scraped AS (
SELECT schno, CASE WHEN CAST(schno AS INT) % 5 = 0 THEN 'NO_SALES_FOUND'
  WHEN CAST(schno AS INT) % 7 = 0 THEN concat('Addr: | ', address, ' | | ', schno, ' | 1/1/2003 | WD | $500,000')
  WHEN CAST(schno AS INT) % 11 = 0 THEN ' | 791376 | 5202005 | WD | $543,500'
  WHEN CAST(schno AS INT) % 13 = 0 THEN ' | 791377 | 5/20/2005 | WD | $500f'
  ELSE concat(' | ', schno, ' | 5/20/2002 | WD | $', CAST(100 + CAST(schno AS INT) % 800 AS VARCHAR(4)), ',500') END AS raw_sales_row
FROM parcels)"""

SALE_PAGES = """
sale_pages AS (
SELECT schno AS id, concat('<html><body><table><tr><th>Reception</th><th>Sale Date</th></tr><tr><td>', schno, '</td><td>5/20/2002</td><td>WD</td><td>$',
  CAST(100 + CAST(schno AS INT) % 800 AS VARCHAR(4)), ',500</td></tr><tr><td>Primary:</td><td>OWNER ', schno, '</td></tr></table></body></html>') AS html FROM parcels WHERE CAST(schno AS INT) % 3 <> 0
UNION ALL SELECT schno, '<html><body>No record found for Account</body></html>' FROM parcels WHERE CAST(schno AS INT) % 3 = 0)"""

PREDICTIONS = """
predictions AS (
SELECT schno, town AS city,
  CASE CAST(schno AS INT) % 3 WHEN 0 THEN 'Condo' WHEN 1 THEN 'Single Family' ELSE 'Other' END AS prop_type, recdate1 AS tx_date,
  CAST(100000 + CAST(schno AS INT) * 1700 AS DOUBLE) AS actual,
  CAST(100000 + CAST(schno AS INT) * 1700 AS DOUBLE) * CAST(80 + CAST(schno AS INT) % 41 AS DOUBLE) / CAST(100 AS DOUBLE) AS predicted
FROM parcels)"""

# Sale events and metrics (Q1-Q2, W1-W4), restated in SQL over ``parcels``.
EVENTS = """
events0 AS (
  SELECT p.*, u.tx_date, u.doc_fee, u.slot FROM parcels p,
  LATERAL (VALUES (p.recdate1, p.docfee1, '1'), (p.recdate2, p.docfee2, '2'),
                  (p.recdate3, p.docfee3, '3'), (p.recdate4, p.docfee4, '4')) AS u(tx_date, doc_fee, slot)),
sale_events AS (
  SELECT *, CAST(trunc(CASE WHEN doc_fee < 10000 THEN doc_fee * 10000 ELSE doc_fee END) AS BIGINT) AS estimated_price
  FROM events0 WHERE tx_date IS NOT NULL AND doc_fee > 0)"""

METRICS = EVENTS + """,
metrics0 AS (
  SELECT schno, tx_date, estimated_price,
    LAG(estimated_price) OVER (PARTITION BY schno ORDER BY tx_date, slot DESC) AS prev_price,
    CAST(tx_date - LAG(tx_date) OVER (PARTITION BY schno ORDER BY tx_date, slot DESC) AS DOUBLE) AS days_held,
    COUNT(*) OVER (PARTITION BY schno) AS times_sold,
    CASE town WHEN 'B' THEN 'BRECKENRIDGE' WHEN 'F' THEN 'FRISCO' WHEN 'D' THEN 'DILLON' WHEN 'S' THEN 'SILVERTHORNE'
      WHEN 'K' THEN 'KEYSTONE' WHEN 'C' THEN 'COPPER/COUNTY' WHEN 'M' THEN 'MONTEZUMA' WHEN 'R' THEN 'RURAL'
      WHEN 'BR' THEN 'BLUE RIVER' WHEN 'H' THEN 'HEENEY' ELSE 'OTHER/COUNTY' END AS city,
    sfla, CASE WHEN adj_year_blt > year_blt THEN 1 ELSE 0 END AS is_renovated,
    units, address, grade, cond, scenic_view, slot
  FROM sale_events),
metrics AS (
  SELECT *, round((estimated_price - prev_price) * 100.0 / nullif(prev_price, 0), 2) AS growth_pct,
    strftime(tx_date, '%Y') AS tx_year
  FROM metrics0)"""

BLOCKS = {
    "parcels": PARCELS, "raw_text": RAW_TEXT, "owners": OWNERS, "address_points": ADDRESS_POINTS,
    "macro": MACRO, "scraped": SCRAPED, "sale_pages": SALE_PAGES, "predictions": PREDICTIONS,
    "events": EVENTS, "metrics": METRICS,
}


def with_tables(*names: str, extra: str = "") -> str:
    """``WITH`` clause defining the named fixture blocks (parcels always first)."""
    order = ["parcels"] + [n for n in names if n != "parcels"]
    body = ",".join(BLOCKS[n] for n in order)
    if extra:
        body += "," + extra
    return "WITH " + body + "\n"

BUILDINGS = """
code_table AS (SELECT
  CASE WHEN p_partkey < 4 THEN ['1212', '1214', '1230', '1231'][p_partkey + 1] ELSE CAST(p_partkey + 3000 AS VARCHAR) END AS code,
  ['RESIDENTIAL VACANT LAND', 'COMMERCIAL VACANT LAND', 'SINGLE FAMILY LAND', 'LODGING STRUCTURE', 'INDUSTRIAL VACANT LOTS',
   'MERCHANDISING STRUCTURE', 'WAREHOUSE/STORAGE STRUCTURE', 'LEASEHOLD CONDO/HOTEL LAND', 'CHURCH LAND',
   'SCHOOL DISTRICT LAND', 'AGRICULTURAL GRAZING LAND'][p_partkey % 11 + 1] AS description FROM part),
coded AS (SELECT *, CASE WHEN CAST(schno AS INT) % 17 = 0 THEN '9999 '
    WHEN CAST(schno AS INT) % 3 = 0 THEN ['1212 ', '1214 ', '1230 ', '1231 '][CAST(schno AS INT) % 4 + 1]
    ELSE concat(CAST(CAST(schno AS INT) % 190 + 3004 AS VARCHAR), ' ') END AS bldg_code FROM parcels),
buildings AS (
  SELECT p.* REPLACE (CASE WHEN CAST(p.schno AS INT) % 4 = 0 THEN 0.0 ELSE CAST(CAST(p.schno AS INT) % 3 * 200 AS DOUBLE) END AS garage_size),
    CASE WHEN trim(p.bldg_code) IN ('1212') THEN 'Single Family Home'
         WHEN trim(p.bldg_code) IN ('1214', '1230', '1231') THEN 'Apartment/Condo/Townhome'
         WHEN lower(c.description) LIKE '%residential%' OR lower(c.description) LIKE '%dwelling%' OR lower(c.description) LIKE '%apartment%' OR lower(c.description) LIKE '%residence%' OR lower(c.description) LIKE '%res%' THEN 'Residential'
         WHEN lower(c.description) LIKE '%commercial%' OR lower(c.description) LIKE '%store%' OR lower(c.description) LIKE '%office%' OR lower(c.description) LIKE '%hotel%' OR lower(c.description) LIKE '%lodging%' OR lower(c.description) LIKE '%retail%' OR lower(c.description) LIKE '%bank%' THEN 'Commercial'
         WHEN lower(c.description) LIKE '%industrial%' OR lower(c.description) LIKE '%warehouse%' OR lower(c.description) LIKE '%factory%' THEN 'Industrial'
         WHEN lower(c.description) LIKE '%public%' OR lower(c.description) LIKE '%school%' OR lower(c.description) LIKE '%church%' OR lower(c.description) LIKE '%hospital%' OR lower(c.description) LIKE '%government%' THEN 'Public/Institutional'
         ELSE 'Other' END AS building_type
  FROM coded p LEFT JOIN code_table c ON c.code = trim(p.bldg_code))"""

OWNER_FRAME = OWNERS + "," + BUILDINGS + """,
owner_frame AS (
  SELECT b.schno, b.city, b.state, b.sfla, b.garage_size, b.building_type, o.primary_owner,
    CASE WHEN o.primary_owner IS NULL THEN 'Unknown'
      WHEN upper(o.primary_owner) LIKE '%LLC%' OR upper(o.primary_owner) LIKE '%LIMITED LIABILITY%' THEN 'LLC / Limited Liability'
      WHEN upper(o.primary_owner) LIKE '%TRUST%' OR upper(o.primary_owner) LIKE '%TR%' OR upper(o.primary_owner) LIKE '%TRUSTEE%' THEN 'Trust'
      WHEN upper(o.primary_owner) LIKE '%INC%' OR upper(o.primary_owner) LIKE '%CORP%' OR upper(o.primary_owner) LIKE '%INCORPORATED%' OR upper(o.primary_owner) LIKE '%LTD%' THEN 'Corporation'
      WHEN upper(o.primary_owner) LIKE '%PARTNERS%' OR upper(o.primary_owner) LIKE '%LP%' OR upper(o.primary_owner) LIKE '%LLP%' THEN 'Partnership'
      WHEN upper(o.primary_owner) LIKE '%CHURCH%' OR upper(o.primary_owner) LIKE '%DIOCESE%' OR upper(o.primary_owner) LIKE '%MINISTRIES%' OR upper(o.primary_owner) LIKE '%TEMPLE%' OR upper(o.primary_owner) LIKE '%SYNAGOGUE%' OR upper(o.primary_owner) LIKE '%MOSQUE%' THEN 'Church / Religious'
      ELSE 'Individual' END AS owner_type,
    CASE WHEN b.city IN ('BRECKENRIDGE', 'FRISCO', 'DILLON', 'SILVERTHORNE', 'KEYSTONE', 'COPPER MOUNTAIN') THEN 'In-County'
      WHEN b.state = 'CO' THEN 'In-State (Out of County)' ELSE 'Out of State' END AS location_type
  FROM buildings b LEFT JOIN owners o ON o.schno = b.schno)"""

SITUS = """
situs AS (
  SELECT schno, town, num, pdir, name, suff, sdir, unit, city, state,
    CASE k % 4 WHEN 0 THEN upper(concat_ws(' ', CAST(num AS VARCHAR), pdir, name, suff, CASE WHEN unit IS NOT NULL THEN '#' || unit END))
      WHEN 1 THEN upper(CAST(num AS VARCHAR) || ' ' || name || ' AVE')
      WHEN 2 THEN 'PO BOX ' || CAST(k % 300 AS VARCHAR)
      ELSE address END AS address
  FROM (SELECT schno, town, address, city, state, CAST(schno AS INT) AS k,
    CASE WHEN CAST(schno AS INT) % 13 = 0 THEN 0 ELSE CAST(schno AS INT) % 997 END AS num,
    CASE WHEN CAST(schno AS INT) % 4 = 0 THEN 'N' END AS pdir,
    CASE CAST(schno AS INT) % 3 WHEN 0 THEN 'Main' WHEN 1 THEN 'Ski Hill' ELSE 'Park' END AS name,
    CASE CAST(schno AS INT) % 2 WHEN 0 THEN 'St' ELSE 'Rd' END AS suff,
    CAST(NULL AS VARCHAR) AS sdir,
    CASE WHEN CAST(schno AS INT) % 5 = 0 THEN CAST(CAST(schno AS INT) % 40 AS VARCHAR) END AS unit
  FROM parcels) s)"""

BLOCKS.update({"buildings": BUILDINGS, "owner_frame": OWNER_FRAME, "situs": SITUS})

INDEX = """
annual_index AS (
  SELECT year, avg_value, (avg_value / LAG(avg_value) OVER (ORDER BY year) - 1) * 100 AS return_pct
  FROM (SELECT CAST(year(l_shipdate) AS INT) AS year, AVG(l_extendedprice) AS avg_value FROM lineitem GROUP BY 1) a)"""

BLOCKS["annual_index"] = INDEX

CPI = """
cpi AS (
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, round(AVG(l_tax) * 1000, 6) AS value FROM lineitem GROUP BY 1)"""

BLOCKS["cpi"] = CPI

LIFTS = """
lift_segments AS (
SELECT CASE WHEN k % 97 = 0 THEN concat(CASE k % 4 WHEN 0 THEN 'Peak 8' WHEN 1 THEN 'river run' WHEN 2 THEN 'AMERICAN EAGLE' ELSE 'Pallavicini' END, ' Lift ', schno)
  WHEN k % 97 = 1 THEN 'Scenic Gondola' END AS name, lon AS x1, lat AS y1, lon + 0.004 AS x2, lat - 0.003 AS y2
FROM (SELECT schno, CAST(schno AS INT) AS k, 39.45 + CAST(CAST(schno AS INT) * 13 % 200 AS DOUBLE) / 1000.0 AS lat,
             -106.20 + CAST(CAST(schno AS INT) * 17 % 330 AS DOUBLE) / 1000.0 AS lon FROM parcels) p WHERE k % 97 < 3)"""
BLOCKS["lifts"] = LIFTS

MACRO_SERIES = """
macro_series AS (
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, round(AVG(l_discount) * 100, 6) AS mortgage_rate, round(AVG(l_tax) * 1000, 6) AS cpi,
  round(AVG(l_extendedprice) / 100, 6) AS sp500, CASE WHEN month(any_value(l_shipdate)) = 1 THEN CAST(COUNT(*) AS DOUBLE) END AS county_pop
FROM lineitem GROUP BY 1)"""
BLOCKS["macro_series"] = MACRO_SERIES
