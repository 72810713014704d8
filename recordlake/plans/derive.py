"""Derived inputs for the registered queries, as SQL expressions.

The driver's tables carry no nulls, no permit text and no registry pages, so the
queries derive them from the tables row by row (every row is kept; nothing is sampled).
Each expression is valid in Spark SQL and in DuckDB, so a query and its oracle start
from identical inputs.
"""

# A null key for some rows: records that never got a key.
EVENT_USER_KEY = "CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END"
ORDER_PERMIT_KEY = "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END"
CUSTOMER_PERMIT_KEY = "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END"
CUSTOMER_LICENSE = "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END"
# A failed look-up: blank name.
SUPPLIER_LOOKUP_NAME = "CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END"

# Free-text permit descriptions written from `part` columns, five shapes.
PART_DESCRIPTION = """CASE p_size % 5
 WHEN 0 THEN 'Digital.  ' || CAST(p_size AS STRING) || ' - ' || p_brand || ' ' || CAST(150 + p_size * 10 AS STRING)
   || ' Watt Modules.  1 - Inverter.  Final required.'
 WHEN 1 THEN 'Web.  Roof PV solar - ' || CAST(p_size % 9 + 1 AS STRING) || '.' || lpad(CAST(p_partkey % 100 AS STRING), 2, '0')
   || 'kW - ' || CAST(p_size AS STRING) || ' panels - ' || CAST(p_size % 3 + 1 AS STRING) || ' batteries (13.5 kWh each). Final required.'
 WHEN 2 THEN 'Digital: ' || CAST(p_size % 7 + 2 AS STRING) || '.' || lpad(CAST(p_partkey % 100 AS STRING), 2, '0')
   || ' Kw - ' || CAST(p_size AS STRING) || ' Modules PV roof top solar mount and (' || CAST(p_size % 2 + 1 AS STRING)
   || ') 13.5Kw Battery to be installed on detached garage.'
 WHEN 3 THEN 'Ground mount array ' || p_name || ', ' || CAST(p_size AS STRING) || ' modules ' || CAST(180 + p_size * 7 AS STRING) || 'W'
 ELSE CASE WHEN p_partkey % 7 = 0 THEN '99999999999 panels. ' ELSE '' END || 'Battery backup: ' || CAST(p_size % 4 + 1 AS STRING) || ' 10 kWh battery units, ' || p_type || ' ' || p_name
END"""

# A registry page per supplier as captured: any case, quoting and form of the line break after the name.
SUPPLIER_PAGE_HTML = """CASE s_suppkey % 3
 WHEN 0 THEN '<html><body><table><tr><td class="label">Business</td><td id="MainContent_BusInfo"> ' || s_name || ' <br>'
 WHEN 1 THEN '<table><tr><td>Business</td><TD class=x id=''MainContent_BusInfo''>' || s_name || '<br/>'
 ELSE '<table><tr><td>Business</td><td ID=MainContent_BusInfo >' || s_name || '<BR />' END
 || CAST(s_suppkey AS STRING) || ' Main St<br>CA</td></tr></table></body></html>'"""
SUPPLIER_PAGE_URL = """CASE WHEN s_nationkey = 3 THEN 'https://registry.example/Error.aspx?code=' ELSE
 'https://registry.example/check?code=' END || CAST(s_suppkey AS STRING)"""

# A captured page with a permit detail block (label cell, value cell, next field) at its end. Every fourth
# cell is empty; the others hold the page id, in the markup that pages are captured in.
PAGE_WITH_DETAIL = """html || CASE page_id % 4
 WHEN 0 THEN '<div class="MoreDetail_ItemCol1 x"><span> License  Number: </span></div>  <div class="MoreDetail_ItemCol2"><span>  <b>'
   || CAST(page_id AS STRING) || '</b> &amp; 4   </span></div>'
 WHEN 1 THEN '<DIV id=d CLASS=MoreDetail_ItemCol1><SPAN>License Number:</SPAN></DIV><DIV><SPAN>' || CAST(page_id AS STRING) || '</SPAN></DIV>'
 WHEN 2 THEN '<div class="MoreDetail_ItemCol1"><span>License Number:</span></div><div class="MoreDetail_ItemCol2"></div>'
 ELSE '<div class=''a MoreDetail_ItemCol1 b''><span>License Number:</span></div ><div><i>no</i><span>' || CAST(page_id AS STRING)
   || '&nbsp;</span></div>' END
 || '<div class="MoreDetail_ItemCol1"><span>Phone:</span></div><div class="MoreDetail_ItemCol2"><span>555</span></div>'"""
# What the cell says, written from the markup above.
PAGE_DETAIL_VALUE = """CASE page_id % 4 WHEN 0 THEN CAST(page_id AS STRING) || ' & 4' WHEN 2 THEN NULL ELSE CAST(page_id AS STRING) END"""
