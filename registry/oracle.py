"""SQL each query is compared with, over the same Parquet tables.

Written apart from the DataFrame code: named views over the sample are stacked in front of the
final select as needed. Divisions guard against zero, money is decimal(38,2), averages are rounded
to nine places.
"""

from __future__ import annotations

import re

TAGS = "'build-0' as build_id, date '{as_of}' as as_of_date"
VERSION = "'CUSTOMER_VALUE_VOLUME_BREADTH_V1' as segmentation_version"

# Views, each a select that may use the tables and the views before it.
VIEWS = {
    "people": """
        select o_orderkey as customer_id,
               'u' || cast(o_orderkey - o_orderkey % 3 as varchar) as customer_unique_id,
               c_nationkey as customer_zip_code_prefix,
               c_mktsegment as customer_city,
               upper(n_name) as customer_state
        from orders, customer, nation
        where o_custkey = c_custkey and c_nationkey = n_nationkey""",
    "purchases": """
        select o_orderkey as order_id,
               o_orderkey as customer_id,
               case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'canceled' end as order_status,
               o_orderdate as purchased_at,
               o_orderdate + interval 1 hour as approved_at,
               o_orderdate + interval 2 day as delivered_carrier_at,
               case when o_orderstatus = 'F' and o_orderkey % 50 <> 0
                    then cast(cast(o_orderdate as date) + cast(o_orderkey % 45 as integer) as timestamp) end
                   as delivered_customer_at,
               o_orderdate + interval 30 day as estimated_delivery_at
        from orders""",
    "addressed": """
        select order_id, customer_unique_id, customer_id, order_status, purchased_at, approved_at,
               delivered_carrier_at, delivered_customer_at, estimated_delivery_at,
               customer_zip_code_prefix, customer_city, customer_state
        from purchases left join people using (customer_id)""",
    "sold": """
        select l_orderkey as order_id, l_linenumber as order_item_id, l_partkey as product_id,
               l_suppkey as seller_id, l_shipdate as shipping_limit_at,
               cast(l_extendedprice as decimal(18,2)) as price, cast(l_quantity as decimal(18,2)) as freight
        from lineitem""",
    "scores": """
        select event_id + event_id % 2 as order_id, 1 + cast(floor(value) as integer) % 5 as score from events""",
    "goods": """
        select p_partkey as product_id, p_type as category_name_pt,
               case p_type when 'PROMO' then 'unknown' else lower(p_type) end as category_name
        from part""",
    "shops": """
        select s_suppkey as seller_id, s_nationkey as zip, s_name as city, upper(n_name) as seller_state
        from supplier, nation where s_nationkey = n_nationkey""",
    "basket": """
        select order_id, count(*) as units, count(distinct product_id) as distinct_products,
               count(distinct seller_id) as distinct_sellers, sum(price) as gmv, sum(freight) as freight
        from sold group by order_id""",
    "receipts": """
        select l_orderkey as order_id, count(*) as payment_rows, count(distinct lower(l_returnflag)) as payment_methods,
               sum(cast(l_extendedprice as decimal(18,2)) + cast(l_quantity as decimal(18,2))
                   - case when l_orderkey % 20 = 0 then 1.50 else 0.00 end) as paid
        from lineitem group by l_orderkey""",
    "opinions": """
        select order_id, sum(score) / count(score) as review_score, count(*) as review_rows
        from scores group by order_id""",
    "tracked": """
        select *, order_status = 'delivered' and delivered_customer_at is not null as arrived from addressed""",
    "wide": """
        select t.order_id, customer_unique_id, customer_id, order_status, purchased_at, approved_at,
               delivered_carrier_at, delivered_customer_at, estimated_delivery_at,
               customer_zip_code_prefix, customer_city, customer_state,
               ifnull(units, 0) as units, ifnull(distinct_products, 0) as distinct_products,
               ifnull(distinct_sellers, 0) as distinct_sellers,
               cast(ifnull(gmv, 0) as decimal(38,2)) as merchandise_gmv_brl,
               cast(ifnull(freight, 0) as decimal(38,2)) as freight_value_brl,
               cast(ifnull(paid, 0) as decimal(38,2)) as paid_value_brl,
               ifnull(payment_rows, 0) as payment_rows, ifnull(payment_methods, 0) as payment_methods,
               review_score, ifnull(review_rows, 0) as review_rows,
               if(arrived, cast(delivered_customer_at as date) - cast(estimated_delivery_at as date), null)
                   as delivery_delay_days,
               if(arrived, delivered_customer_at > estimated_delivery_at, null) as is_late
        from tracked t
        left join basket b on b.order_id = t.order_id
        left join receipts r on r.order_id = t.order_id
        left join opinions v on v.order_id = t.order_id""",
    "seen": "select * from wide where cast(purchased_at as date) <= date '{as_of}'",
    "monthly": """
        select cast(date_trunc('month', purchased_at) as date) as month_start,
               count(*) as orders, count(distinct customer_unique_id) as customers,
               cast(sum(done) as bigint) as delivered_orders,
               cast(sum(if(order_status = 'canceled' or order_status = 'unavailable', 1, 0)) as bigint) as failed_orders,
               cast(sum(if(done = 1, merchandise_gmv_brl, null)) as decimal(38,2)) as merchandise_gmv_brl,
               cast(sum(if(done = 1, freight_value_brl, null)) as decimal(38,2)) as freight_value_brl,
               cast(sum(if(done = 1, units, null)) as bigint) as units,
               cast(sum(if(done = 1, merchandise_gmv_brl, null)) as double) / nullif(sum(done), 0) as avg_order_value_brl,
               sum(if(done = 1, review_score, null)) / nullif(count(if(done = 1, review_score, null)), 0)
                   as avg_review_score,
               sum(if(done = 1, cast(is_late as integer), null)) / nullif(count(if(done = 1, is_late, null)), 0)
                   as late_delivery_rate
        from (select *, if(order_status = 'delivered', 1, 0) as done from seen)
        group by 1""",
    "lines": """
        select s.order_id, customer_unique_id, review_score, is_late, product_id, seller_id, price, s.freight
        from seen w join sold s on s.order_id = w.order_id
        where order_status = 'delivered'""",
    "base": """
        select customer_unique_id, count(distinct order_id) as delivered_orders, count(*) as units,
               count(distinct l.product_id) as distinct_products,
               count(distinct nullif(category_name, 'unknown')) as distinct_categories,
               cast(sum(price) as decimal(38,2)) as merchandise_gmv_brl,
               cast(sum(freight) as decimal(38,2)) as freight_value_brl
        from lines l left join goods g on g.product_id = l.product_id
        where price >= 0 and customer_unique_id is not null
        group by customer_unique_id""",
    "gmv_shares": """
        select merchandise_gmv_brl, count(*) as members,
               cast(sum(merchandise_gmv_brl) as decimal(38,2)) as bucket
        from base group by 1""",
    "gmv_running": """
        select merchandise_gmv_brl,
               cast(ifnull(sum(bucket) over (order by merchandise_gmv_brl desc
                           rows between unbounded preceding and 1 preceding), 0) as double)
                   / nullif(cast(sum(bucket) over () as double), 0) as share
        from gmv_shares""",
    "freight_shares": """
        select freight_value_brl, count(*) as members, cast(sum(freight_value_brl) as decimal(38,2)) as bucket
        from base group by 1""",
    "freight_running": """
        select freight_value_brl,
               cast(ifnull(sum(bucket) over (order by freight_value_brl desc
                           rows between unbounded preceding and 1 preceding), 0) as double)
                   / nullif(cast(sum(bucket) over () as double), 0) as share
        from freight_shares""",
    "segments": """
        select b.*,
               case when b.merchandise_gmv_brl <= 0 then 'NO_VALUE' when share < 0.80 then 'A_HIGH_VALUE'
                    when share < 0.95 then 'B_MEDIUM_VALUE' else 'C_LOW_VALUE' end as value_segment,
               case when units = 1 then 'ONE_ITEM' when units in (2, 3) then 'TWO_TO_THREE'
                    else 'FOUR_PLUS' end as unit_segment,
               case distinct_categories when 0 then 'UNKNOWN' when 1 then 'SPECIALIST' when 2 then 'MIXED'
                    else 'DIVERSIFIED' end as category_segment,
               if(distinct_categories = 0, 'DIRECTIONAL', 'PUBLISHABLE') as coverage_status
        from base b join gmv_running r on r.merchandise_gmv_brl = b.merchandise_gmv_brl""",
    "tall": """
        select *, unnest(['VALUE', 'UNITS', 'CATEGORIES']) as segment_dimension,
               unnest([value_segment, unit_segment, category_segment]) as segment_label
        from segments""",
    "summary_totals": """
        select segment_dimension, segment_label, count(*) as customers,
               cast(sum(merchandise_gmv_brl) as decimal(38,2)) as merchandise_gmv_brl,
               cast(sum(units) as bigint) as units,
               sum(delivered_orders) / count(*) as avg_delivered_orders,
               sum(distinct_categories) / count(*) as avg_distinct_categories
        from tall group by 1, 2""",
    "summary": """
        select s.*, cast(s.merchandise_gmv_brl as double) / nullif(cast(whole as double), 0) as gmv_share,
               'PUBLISHABLE' as coverage_status
        from summary_totals s
        join (select segment_dimension, sum(merchandise_gmv_brl) as whole from summary_totals group by 1) d
          on d.segment_dimension = s.segment_dimension""",
    "crossed": """
        select value_segment, unit_segment, category_segment, count(*) as customers,
               cast(sum(merchandise_gmv_brl) as decimal(38,2)) as merchandise_gmv_brl,
               cast(sum(units) as bigint) as units,
               sum(distinct_categories) / count(*) as avg_distinct_categories,
               if(count(*) < 30, 'SUPPRESSED', 'PUBLISHABLE') as coverage_status
        from segments group by all""",
    "affinity": """
        select value_segment, category_name, count(distinct l.customer_unique_id) as customers, count(*) as units,
               cast(sum(price) as decimal(38,2)) as merchandise_gmv_brl,
               if(count(distinct l.customer_unique_id) < 30, 'SUPPRESSED', 'PUBLISHABLE') as coverage_status
        from segments s
        join lines l on l.customer_unique_id = s.customer_unique_id
        join goods g on g.product_id = l.product_id
        group by 1, 2""",
    "categories": """
        select category_name, count(*) as units, count(distinct order_id) as orders,
               count(distinct customer_unique_id) as customers,
               cast(sum(price) as decimal(38,2)) as merchandise_gmv_brl,
               cast(sum(price) as double) / nullif(count(price), 0) as avg_item_value_brl,
               sum(review_score) / nullif(count(review_score), 0) as avg_review_score,
               if(count(distinct order_id) < 30, 'SUPPRESSED', 'PUBLISHABLE') as coverage_status
        from lines l join goods g on g.product_id = l.product_id
        group by 1""",
    "merchants": """
        select l.seller_id, seller_state, count(distinct order_id) as orders, count(*) as units,
               cast(sum(price) as decimal(38,2)) as merchandise_gmv_brl,
               sum(review_score) / nullif(count(review_score), 0) as avg_review_score,
               sum(cast(is_late as integer)) / nullif(count(is_late), 0) as late_delivery_rate,
               if(count(distinct order_id) < 30, 'SUPPRESSED', 'PUBLISHABLE') as coverage_status
        from lines l join shops s on s.seller_id = l.seller_id
        group by 1, 2""",
    "deliveries": """
        select cast(date_trunc('month', purchased_at) as date) as month_start,
               case is_late when true then 'LATE' when false then 'ON_TIME' else 'UNKNOWN' end as delivery_status,
               count(*) as orders,
               sum(review_score) / nullif(count(review_score), 0) as avg_review_score,
               sum(delivery_delay_days) / nullif(count(delivery_delay_days), 0) as avg_delivery_delay_days,
               count(review_score) as reviewed_orders,
               if(count(*) < 30, 'SUPPRESSED', 'PUBLISHABLE') as coverage_status
        from seen
        where order_status = 'delivered'
          and ifnull(approved_at >= purchased_at, true)
          and ifnull(delivered_customer_at >= purchased_at, true)
          and ifnull(delivered_customer_at >= delivered_carrier_at, true)
        group by 1, 2""",
    "impossible": """
        select order_id from purchases
        where approved_at < purchased_at or delivered_customer_at < purchased_at
           or delivered_customer_at < delivered_carrier_at""",
    "unpaid": """
        select * from wide
        where abs(paid_value_brl - merchandise_gmv_brl - freight_value_brl) > 1
          and order_status <> 'canceled' and order_status <> 'unavailable'""",
    "observed": """
        select * from (values
            ('orders_pk_unique', 'HIGH', 0.0,
             (select count(*) - count(distinct order_id) from addressed),
             'order_id debe ser unico en fct_order'),
            ('customers_bridge_pk_unique', 'HIGH', 0.0,
             (select count(*) - count(distinct customer_id) from people),
             'customer_id debe ser unico en el puente pedido-cliente'),
            ('order_items_pk_unique', 'HIGH', 0.0,
             (select sum(n - 1) from (select count(*) as n from sold group by order_id, order_item_id)),
             'order_id + order_item_id debe ser unico'),
            ('orders_without_customer', 'HIGH', 0.0,
             (select count(*) from addressed where customer_unique_id is null),
             'Todo pedido debe resolver customer_unique_id'),
            ('items_without_order', 'HIGH', 0.0,
             (select count(*) from sold where order_id not in (select order_id from purchases)),
             'Todo item debe resolver un pedido'),
            ('items_without_product', 'HIGH', 0.0,
             (select count(*) from sold where product_id not in (select product_id from goods)),
             'Todo item debe resolver un producto'),
            ('items_without_seller', 'HIGH', 0.0,
             (select count(*) from sold where seller_id not in (select seller_id from shops)),
             'Todo item debe resolver un vendedor'),
            ('negative_item_values', 'HIGH', 0.0,
             (select count(*) from sold where price < 0),
             'Los importes de item no pueden ser negativos'),
            ('invalid_order_chronology_source', 'MEDIUM', 0.0,
             (select count(*) from impossible),
             'Filas excluidas de metricas operativas; el dato fuente no se corrige'),
            ('customer_segment_unique', 'HIGH', 0.0,
             (select count(*) - count(distinct customer_unique_id) from segments),
             'Cada cliente elegible debe tener una sola segmentacion'),
            ('customer_segment_complete', 'HIGH', 0.0,
             (select count(*) from segments where (value_segment || unit_segment || category_segment) is null),
             'Las tres dimensiones de segmentacion son obligatorias'),
            ('customer_gmv_reconciliation', 'HIGH', 0.01,
             (select abs(sum(g)) from (select sum(merchandise_gmv_brl) as g from segments
                                       union all select -sum(price) from lines where price >= 0)),
             'El GMV segmentado debe reconciliar con items elegibles'),
            ('unknown_product_categories', 'MEDIUM', 0.0,
             (select count(*) from goods where category_name = 'unknown'),
             'Categorias sin traduccion o clasificacion'),
            ('orders_payment_difference_gt_1', 'MEDIUM', 0.0,
             (select count(*) from unpaid),
             'Diferencias pueden incluir vouchers y ajustes; se informan, no se imputan'),
            ('orders_without_review', 'MEDIUM', 0.0,
             (select count(*) from wide where order_status = 'delivered' and review_rows = 0),
             'Pedidos entregados sin review')
        ) as t(check_id, severity, threshold, observed, details)""",
    "checks": """
        select check_id, severity, if(ifnull(observed <= threshold, false), 'PASS', 'FAIL') as status,
               cast(observed as double) as observed_value, cast(threshold as double) as threshold, details
        from observed""",
}


def _views_for(text: str) -> list[str]:
    """Names of the views a select needs, in stacking order."""
    needed: set[str] = set()
    pending = [text]
    while pending:
        words = set(re.findall(r"[a-z_]+", pending.pop()))
        for name in VIEWS:
            if name in words and name not in needed:
                needed.add(name)
                pending.append(VIEWS[name])
    return [name for name in VIEWS if name in needed]


def sql(select: str, as_of: str = "1997-12-31") -> str:
    """A select behind the views it needs; one that starts with a comma brings views of its own."""
    views = ",\n".join(f"{name} as ({VIEWS[name]})" for name in _views_for(select))
    own = select.lstrip()
    if not views:
        stacked = f"with {own[1:]}" if own.startswith(",") else own
    else:
        stacked = f"with {views}\n{own}"
    return stacked.replace("{as_of}", as_of)


def r(*columns: str) -> str:
    return ", ".join(f"round({c}, 9) as {c}" for c in columns)


MONTHLY = f"""select {TAGS}, month_start, orders, customers, delivered_orders, failed_orders, merchandise_gmv_brl,
    freight_value_brl, units, {r('avg_order_value_brl', 'avg_review_score', 'late_delivery_rate')} from monthly"""
SEGMENTS = f"""select {TAGS}, {VERSION}, customer_unique_id, delivered_orders, units, distinct_products,
    distinct_categories, merchandise_gmv_brl, freight_value_brl, value_segment, unit_segment, category_segment,
    coverage_status from segments"""
SUMMARY = f"""select {TAGS}, {VERSION}, segment_dimension, segment_label, customers, merchandise_gmv_brl, units,
    {r('avg_delivered_orders', 'avg_distinct_categories', 'gmv_share')}, coverage_status from summary"""
CROSS = f"""select {TAGS}, {VERSION}, value_segment, unit_segment, category_segment, customers, merchandise_gmv_brl,
    units, {r('avg_distinct_categories')}, coverage_status from crossed"""
AFFINITY = f"""select {TAGS}, value_segment, category_name, customers, units, merchandise_gmv_brl, coverage_status
    from affinity"""
CATEGORY = f"""select {TAGS}, category_name, units, orders, customers, merchandise_gmv_brl,
    {r('avg_item_value_brl', 'avg_review_score')}, coverage_status from categories"""
SELLER = f"""select {TAGS}, seller_id, seller_state, orders, units, merchandise_gmv_brl,
    {r('avg_review_score', 'late_delivery_rate')}, coverage_status from merchants"""
DELIVERY = f"""select {TAGS}, month_start, delivery_status, orders,
    {r('avg_review_score', 'avg_delivery_delay_days')}, reviewed_orders, coverage_status from deliveries"""
CHECKS = f"select {TAGS}, check_id, severity, status, observed_value, threshold, details from checks"
ONLY_PUBLIC = " where coverage_status = 'PUBLISHABLE'"

BRAZILIAN = "translate(format('{{:,.{d}f}}', {x}), ',.', '.,')"
MONTH_NAMES = "['ene', 'feb', 'mar', 'abr', 'may', 'jun', 'jul', 'ago', 'sep', 'oct', 'nov', 'dic']"


def money(x: str) -> str:
    return "'R$ ' || " + BRAZILIAN.format(d=2, x=f"cast({x} as double)")


def whole(x: str) -> str:
    return BRAZILIAN.format(d=0, x=f"cast({x} as double)")


def weighted(value: str, weight: str, where: str = "true") -> str:
    return f"""sum(if({where}, {value} * {weight}, null)) / nullif(sum(if({where}, {weight}, null)), 0)"""


def month_name(day: str) -> str:
    return f"list_extract({MONTH_NAMES}, cast(month({day}) as integer)) || ' ' || cast(year({day}) as varchar)"


def told_apart(name: str, value: str) -> str:
    """A double as a finite number, and in words what else it is."""
    return f"""case when isfinite({value}) then round({value}, 9) end as {name},
        case when isnan({value}) then 'nan' when isinf({value}) then if({value} > 0, 'inf', '-inf') end as {name}_kind"""


def orphans(key: str, rows: str, others: str) -> str:
    return sql(f"select {key}, count(*) as rows from {rows} where {key} not in (select {key} from {others}) group by 1")


_PART_LABEL = """case category_name when 'economy' then 'Económico' when 'standard' then 'Estándar'
    when 'small' then 'Pequeño' when 'medium' then 'Mediano' when 'large' then 'Grande'
    when 'unknown' then 'Sin categoría informada' end"""

ORACLE: dict[str, str] = {
    "dim_customer": sql(
        "select customer_unique_id, count(distinct customer_id) as observed_order_addresses from people group by 1"
    ),
    "bridge_customer_order_address": sql(
        """select cast(customer_id as varchar) as customer_id, customer_unique_id, customer_zip_code_prefix,
                  customer_city, customer_state from people"""
    ),
    "dim_geography": sql(
        """, points as (select c_nationkey as zip, c_acctbal / 100 as lat, -c_acctbal / 50 as lng, c_mktsegment as city,
                               upper(n_name) as state
                        from customer, nation where c_nationkey = n_nationkey),
           cities as (select zip, city, row_number() over (partition by zip order by count(*) desc, city) as place
                      from points group by zip, city),
           states as (select zip, state, row_number() over (partition by zip order by count(*) desc, state) as place
                      from points group by zip, state)
           select p.zip as zip_code_prefix, round(median(lat), 9) as latitude, round(median(lng), 9) as longitude,
                  any_value(c.city) as city, any_value(s.state) as state, count(*) as source_points
           from points p join cities c on c.zip = p.zip and c.place = 1
                join states s on s.zip = p.zip and s.place = 1
           group by 1"""
    ),
    "dim_geography_of_bad_points": sql(
        f"""select zip_code_prefix, {told_apart('latitude', 'middle')}, longitude, source_points from (
                select c_nationkey as zip_code_prefix, count(*) as source_points,
                       median(case when cast(floor(abs(c_acctbal / 100) * 10000) as bigint) % 3
                                        < if(c_nationkey % 5 = 0, 2, 1)
                                   then 'nan'::double else c_acctbal / 100 end) as middle,
                       round(median(-c_acctbal / 50), 9) as longitude
                from customer, nation where c_nationkey = n_nationkey group by 1)"""
    ),
    "dim_product": sql(
        """select cast(p_partkey as varchar) as product_id, category_name_pt, category_name, p_size as photos_qty,
                  p_retailprice as weight_g, cast(p_size as double) as length_cm, cast(null as double) as height_cm,
                  cast(null as double) as width_cm
           from part join goods on product_id = p_partkey"""
    ),
    "dim_seller": sql(
        """select cast(seller_id as varchar) as seller_id, zip as seller_zip_code_prefix, city as seller_city,
                  seller_state from shops"""
    ),
    "fct_order": sql(
        """select cast(order_id as varchar) as order_id, customer_unique_id, cast(customer_id as varchar) as customer_id,
                  order_status, purchased_at, approved_at, delivered_carrier_at, delivered_customer_at,
                  estimated_delivery_at, customer_zip_code_prefix, customer_city, customer_state
           from addressed"""
    ),
    "fct_order_item": sql(
        """select cast(order_id as varchar) as order_id, order_item_id, cast(product_id as varchar) as product_id,
                  cast(seller_id as varchar) as seller_id, shipping_limit_at, price as item_value_brl,
                  freight as freight_value_brl from sold"""
    ),
    "fct_payment": sql(
        """select cast(l_orderkey as varchar) as order_id, l_linenumber as payment_sequential,
                  lower(l_returnflag) as payment_type, cast(l_quantity as integer) as payment_installments,
                  cast(l_extendedprice as decimal(18,2)) as payment_value_brl from lineitem"""
    ),
    "fct_review": sql(
        """select cast(event_id as varchar) as review_id, cast(event_id + event_id % 2 as varchar) as order_id,
                  1 + cast(floor(value) as integer) % 5 as review_score, event_type as review_comment_title,
                  cast(null as varchar) as review_comment_message, ts as review_created_at,
                  cast(null as timestamp) as review_answered_at from events"""
    ),
    "dim_date": sql(
        """select cast(d as date) as date_day, year(d) as year, month(d) as month_number,
                  strftime(d, '%Y-%m') as year_month, cast(date_trunc('month', d) as date) as month_start,
                  quarter(d) as quarter_number, dayofweek(d) as weekday_number
           from (select unnest(range(min(date_trunc('day', o_orderdate)),
                                     max(date_trunc('day', o_orderdate)) + interval 1 day, interval 1 day)) as d
                 from orders)"""
    ),
    "calendar": sql(
        f"""select cast(d as date) as "Fecha", year(d) as "Anio", month(d) as "Mes numero",
                   year(d) * 100 + month(d) as "Mes indice", {month_name('d')} as "Mes"
            from (select unnest(range(cast(min(month_start) as timestamp),
                                      cast(greatest(max(month_start), date '{{as_of}}') as timestamp) + interval 1 day,
                                      interval 1 day)) as d
                  from monthly)"""
    ),
    "default_as_of": "select cast(max(o_orderdate) as date) as as_of_date from orders",
    "typed_text": sql(
        """select cast(l_orderkey as varchar) as order_id, cast(l_linenumber as varchar) as order_item_id,
                  cast(l_partkey as varchar) as product_id, cast(l_suppkey as varchar) as seller_id,
                  try_cast(cast(l_extendedprice as varchar) as integer) as whole,
                  try_cast(cast(l_extendedprice as varchar) as decimal(18,2)) as money,
                  try_cast(cast(l_extendedprice as varchar) as double) as number,
                  try_cast(cast(l_extendedprice as varchar) || 'd' as double) as suffixed,
                  try_cast('n' || cast(l_extendedprice as varchar) as integer) as lettered,
                  try_cast(cast(l_shipdate as varchar) as timestamp) as moment,
                  try_cast(left(cast(l_shipdate as varchar), 7) as timestamp) as month_only,
                  nullif(trim('  ' || if(l_quantity = 1, '', 'x')), '') as trimmed
           from lineitem"""
    ),
    "order_summary": sql(
        f"""select * replace (round(review_score, 9) as review_score) from wide"""
    ),
    "executive_monthly": sql(MONTHLY),
    "delivered_lines": sql(
        f"""select order_id, customer_unique_id, {r('review_score')}, is_late, product_id, seller_id,
                   price as item_value_brl, freight as freight_value_brl from lines"""
    ),
    "customer_base": sql("select * from base"),
    "value_buckets": sql(
        "select merchandise_gmv_brl, members as customers_in_tie, bucket as bucket_gmv_brl from gmv_shares"
    ),
    "value_buckets_freight": sql(
        "select freight_value_brl, members as customers_in_tie, bucket as bucket_gmv_brl from freight_shares"
    ),
    "bucket_cumulative": sql(
        "select merchandise_gmv_brl, round(share, 9) as cumulative_share_before from gmv_running"
    ),
    "bucket_cumulative_freight": sql(
        "select freight_value_brl, round(share, 9) as cumulative_share_before from freight_running"
    ),
    "customer_segmentation": sql(SEGMENTS),
    "abc_on_freight": sql(
        """select customer_unique_id, b.freight_value_brl,
                  case when b.freight_value_brl <= 0 then 'NO_VALUE' when share < 0.80 then 'A_HIGH_VALUE'
                       when share < 0.95 then 'B_MEDIUM_VALUE' else 'C_LOW_VALUE' end as freight_segment
           from base b join freight_running f on f.freight_value_brl = b.freight_value_brl"""
    ),
    "abc_of_suppliers": sql(
        """, shipped as (select seller_id, cast(sum(price) as decimal(38,2)) as value_brl from sold group by 1),
           placed as (select *, cast(ifnull((select sum(value_brl) from shipped g where g.value_brl > s.value_brl), 0)
                                     as double) / cast((select sum(value_brl) from shipped) as double) as share
                      from shipped s)
           select seller_id, value_brl, case when value_brl <= 0 then 'NO_VALUE' when share < 0.5 then 'A'
                                             when share < 0.9 then 'B' else 'C' end as class
           from placed"""
    ),
    "prefix_by_state": sql(
        """, prices as (select c_nationkey as nation, cast(o_totalprice as decimal(18,2)) as price_brl,
                               sum(cast(o_totalprice as decimal(18,2))) as value_brl
                        from orders, customer where o_custkey = c_custkey group by 1, 2)
           select nation, price_brl, cast(value_brl as decimal(28,2)) as value_brl,
                  cast(ifnull(sum(value_brl) over (partition by nation order by price_brl desc
                              rows between unbounded preceding and 1 preceding), 0) as decimal(38,2)) as sum_before,
                  cast(sum(value_brl) over (partition by nation) as decimal(38,2)) as sum_total
           from prices"""
    ),
    "group_stats": sql(
        """, slots as (select event_type, user_id % 7 as slot,
                              row_number() over (partition by event_type order by count(*) desc, user_id % 7) as place
                       from events group by event_type, user_id % 7)
           select e.event_type, count(*) as events, median(value) as value,
                  median(cast(user_id as double)) as user_number, any_value(s.slot) as slot
           from events e join slots s on s.event_type = e.event_type and place = 1
           group by 1"""
    ),
    "group_median_of_unknown": sql(
        """select case when user_id % 3 = 0 then event_type end as known_type, count(*) as events,
                  median(value) as value
           from events group by 1"""
    ),
    "group_median_of_strange": sql(
        f"""select grp, events, {told_apart('value', 'middle')} from (
                select event_type || '-' || user_id % 11 as grp, count(*) as events,
                       median(case when event_id * 7 % 10 < user_id % 11
                                   then case user_id % 3 when 0 then 'nan' when 1 then 'inf' else '-inf' end::double
                                   when event_id % 13 <> 0 then value end) as middle
                from events group by 1)"""
    ),
    "customer_segment_summary": sql(SUMMARY),
    "customer_cross_segment": sql(CROSS),
    "customer_category_affinity": sql(AFFINITY),
    "category_performance": sql(CATEGORY),
    "seller_performance": sql(SELLER),
    "seller_performance_1995": sql(SELLER, "1995-12-31"),
    "delivery_experience": sql(DELIVERY),
    "quality_checks": sql(CHECKS),
    "quality_summary": sql(
        f"""select {TAGS}, count(*) as checks,
                   count(case when status = 'FAIL' and severity = 'HIGH' then 1 end) as high_failures,
                   count(case when status = 'FAIL' and severity = 'MEDIUM' then 1 end) as medium_warnings,
                   count(case when status = 'FAIL' and severity = 'HIGH' then 1 end) = 0 as publishable
            from checks"""
    ),
    "check_listing": sql(CHECKS + " order by severity, check_id"),
    "key_surplus": sql(
        """select count(*) - (select count(*) from (select distinct order_id from sold)) as order_rows,
                  count(*) - (select count(*) from (select distinct order_id, order_item_id from sold))
                      as order_item_rows,
                  count(*) - (select count(*) from (select distinct order_id, order_item_id, product_id from sold))
                      as order_item_product_rows
           from sold"""
    ),
    "orphan_orders_without_items": orphans("order_id", "purchases", "sold"),
    "orphan_orders_without_reviews": orphans("order_id", "purchases", "scores"),
    "orphan_reviews_without_order": orphans("order_id", "scores", "purchases"),
    "orphan_documents_without_labels": orphans("doc_id", "documents", "labels"),
    "invalid_chronology": sql(
        """select order_id, purchased_at, approved_at, delivered_carrier_at, delivered_customer_at
           from purchases where order_id in (select order_id from impossible)"""
    ),
    "payment_differences": sql(
        "select order_id, order_status, paid_value_brl, merchandise_gmv_brl, freight_value_brl from unpaid"
    ),
    "public_executive_monthly": sql(MONTHLY),
    "public_customer_segment_summary": sql(SUMMARY + ONLY_PUBLIC),
    "public_customer_cross_segment": sql(CROSS + ONLY_PUBLIC),
    "public_customer_category_affinity": sql(AFFINITY + ONLY_PUBLIC),
    "public_category_performance": sql(CATEGORY + ONLY_PUBLIC),
    "public_seller_performance": sql(SELLER + ONLY_PUBLIC),
    "public_delivery_experience": sql(DELIVERY + ONLY_PUBLIC),
    "public_quality_checks": sql(CHECKS),
    "coverage_filter_on_segmentation": sql(SEGMENTS + ONLY_PUBLIC),
    "executive_facts": sql(
        f"""select (select sum(merchandise_gmv_brl) from monthly) as total_gmv_brl,
                   (select cast(sum(customers) as bigint) from summary where segment_dimension = 'VALUE') as customers,
                   (select max(customers) from summary where segment_label = 'A_HIGH_VALUE') as segment_a_customers,
                   (select round(max(gmv_share), 9) from summary where segment_label = 'A_HIGH_VALUE')
                       as segment_a_gmv_share,
                   (select category_name from categories where coverage_status = 'PUBLISHABLE'
                    order by merchandise_gmv_brl desc, category_name limit 1) as top_category,
                   (select max(merchandise_gmv_brl) from categories where coverage_status = 'PUBLISHABLE')
                       as top_category_gmv_brl,
                   (select round({weighted('avg_review_score', 'reviewed_orders')}, 9) from deliveries
                    where coverage_status = 'PUBLISHABLE' and delivery_status = 'ON_TIME') as on_time_review_score,
                   (select round({weighted('avg_review_score', 'reviewed_orders')}, 9) from deliveries
                    where coverage_status = 'PUBLISHABLE' and delivery_status = 'LATE') as late_review_score"""
    ),
    "headline_kpis": sql(
        """select sum(merchandise_gmv_brl) as total_gmv_brl, cast(sum(delivered_orders) as bigint) as delivered_orders,
                  cast(sum(units) as bigint) as units, date '{as_of}' as as_of_date,
                  (select cast(sum(customers) as bigint) from summary where segment_dimension = 'VALUE') as customers
           from monthly"""
    ),
    "monthly_series": sql(
        f"""select month_start, {month_name('month_start')} as month_label, merchandise_gmv_brl,
                   ifnull({money('merchandise_gmv_brl')}, 'Sin datos') as gmv_text
            from monthly order by month_start"""
    ),
    "value_segments": sql(
        f"""select segment_label,
                   case segment_label when 'A_HIGH_VALUE' then 'A · Alto valor' when 'B_MEDIUM_VALUE' then
                        'B · Valor medio' when 'C_LOW_VALUE' then 'C · Bajo valor' else 'Sin valor elegible' end
                       as segment_name,
                   merchandise_gmv_brl, customers, {money('merchandise_gmv_brl')} as gmv_text,
                   {whole('customers')} as customers_text
            from summary where segment_dimension = 'VALUE' order by merchandise_gmv_brl, segment_label"""
    ),
    "top_category": sql(CATEGORY + ONLY_PUBLIC + " order by merchandise_gmv_brl desc, category_name limit 1"),
    "top_categories": sql(
        f"""select * from (
                select category_name, {_PART_LABEL} as category_label, merchandise_gmv_brl, orders,
                       {money('merchandise_gmv_brl')} as gmv_text, {whole('orders')} as orders_text
                from categories where coverage_status = 'PUBLISHABLE'
                order by merchandise_gmv_brl desc, category_name limit 12)
            order by merchandise_gmv_brl, category_name"""
    ),
    "top_brands": sql(
        f"""select * from (
                select category_name, 'Marca ' || substr(category_name, 7) as category_label, merchandise_gmv_brl,
                       orders, {money('merchandise_gmv_brl')} as gmv_text, {whole('orders')} as orders_text
                from categories where coverage_status = 'PUBLISHABLE'
                order by merchandise_gmv_brl desc, category_name limit 12)
            order by merchandise_gmv_brl, category_name"""
    ).replace(VIEWS["goods"], "select p_partkey as product_id, p_brand as category_name from part"),
    "delivery_summary": sql(
        """select delivery_status,
                  case delivery_status when 'LATE' then 'Con demora' when 'ON_TIME' then 'A tiempo'
                       else 'Sin estado informado' end as status_label,
                  orders, reviewed_orders, round(score, 9) as avg_review_score,
                  ifnull(replace(printf('%.2f', score), '.', ','), 'Sin datos') as score_text,
                  translate(format('{:,.0f}', cast(orders as double)), ',.', '.,') as orders_text
           from (select delivery_status, cast(sum(orders) as bigint) as orders,
                        cast(sum(if(avg_review_score is null, 0, reviewed_orders)) as bigint) as reviewed_orders,
                        sum(avg_review_score * reviewed_orders) / nullif(sum(reviewed_orders), 0) as score
                 from deliveries where coverage_status = 'PUBLISHABLE' group by 1)
           order by orders desc"""
    ),
    "category_labels": sql(
        f"""select category_name, count(*) as products, {_PART_LABEL} as category_label,
                   if(category_name = 'unknown', 'Sin categoría informada', null) as published_label
            from goods group by 1"""
    ),
    "unmapped_categories": sql("select distinct category_name from goods where category_name <> 'unknown'"),
    "display_text": sql(
        f"""select o_orderkey, {money('o_totalprice')} as currency_text, {whole('floor(o_totalprice)')} as number_text,
                   replace(printf('%.2f', floor(o_totalprice) / 4), '.', ',') as decimal_text,
                   strftime(o_orderdate, '%d/%m/%Y') as day_text, {month_name('o_orderdate')} as month_text,
                   if(o_orderkey % 2 = 0, {money('o_totalprice')}, 'Sin datos') as gap_text,
                   'R$ ' || {BRAZILIAN.format(d=1, x='o_totalprice * 1000 / 1000000')} || ' M' as millions_text
            from orders"""
    ),
    "spreadsheet_guard": sql(
        """, signed as (select doc_id, text, list_extract(['=', '+', '-', '@', ' '],
                                                          cast(doc_id % 5 + 1 as integer)) || text as s
                        from documents)
           select doc_id, if(left(text, 1) in ('=', '+', '-', '@'), '''' || text, text) as text,
                  if(left(s, 1) in ('=', '+', '-', '@'), '''' || s, s) as signed_text
           from signed"""
    ),
    "measures_monthly": sql(
        f"""select cast(sum(orders) as bigint) as pedidos, cast(sum(delivered_orders) as bigint) as pedidos_entregados,
                   sum(merchandise_gmv_brl) as gmv,
                   round(cast(sum(merchandise_gmv_brl) as double) / nullif(sum(delivered_orders), 0), 9)
                       as ticket_promedio,
                   round(sum(failed_orders) / nullif(sum(orders), 0), 9) as tasa_de_pedidos_fallidos,
                   round({weighted('late_delivery_rate', 'delivered_orders')}, 9) as tasa_de_entrega_tardia
            from monthly"""
    ),
    "measures_by_month": sql(
        """select month_start, sum(merchandise_gmv_brl) as gmv,
                  round(cast(sum(merchandise_gmv_brl) as double) / nullif(sum(delivered_orders), 0), 9)
                      as ticket_promedio
           from monthly group by 1"""
    ),
    "measures_by_calendar_month": sql(
        """select year(month_start) as anio, year(month_start) * 100 + month(month_start) as mes_indice,
                  cast(sum(orders) as bigint) as pedidos, sum(merchandise_gmv_brl) as gmv
           from monthly group by 1, 2"""
    ),
    "measures_segments": sql(
        """select cast(sum(if(segment_dimension = 'VALUE', customers, null)) as bigint) as clientes_elegibles,
                  cast(sum(if(segment_label = 'A_HIGH_VALUE', customers, null)) as bigint) as clientes_alto_valor,
                  round(cast(sum(if(segment_label = 'A_HIGH_VALUE', merchandise_gmv_brl, null)) as double)
                        / cast(sum(if(segment_dimension = 'VALUE', merchandise_gmv_brl, null)) as double), 9)
                      as share_gmv_alto_valor,
                  cast(sum(if(segment_label = 'SPECIALIST', customers, null)) as bigint) as clientes_una_categoria,
                  sum(if(segment_dimension = 'VALUE', merchandise_gmv_brl, null)) as gmv_por_segmento
           from summary"""
    ),
    "measures_by_segment": sql(
        """select segment_label, sum(if(segment_dimension = 'VALUE', merchandise_gmv_brl, null)) as gmv_por_segmento
           from summary group by 1"""
    ),
    "measures_cross": sql(
        """select value_segment, unit_segment, category_segment,
                  cast(sum(if(coverage_status = 'PUBLISHABLE', customers, null)) as bigint) as clientes_cruce
           from crossed group by 1, 2, 3"""
    ),
    "measures_affinity": sql(
        """select category_name, value_segment,
                  sum(if(coverage_status = 'PUBLISHABLE', merchandise_gmv_brl, null)) as gmv_afinidad
           from affinity group by 1, 2"""
    ),
    "measures_category": sql(
        """select sum(merchandise_gmv_brl) as gmv_categorias, round(avg(avg_review_score), 9) as review_categoria
           from categories where coverage_status = 'PUBLISHABLE'"""
    ),
    "measures_by_category": sql(
        """select category_name, sum(if(coverage_status = 'PUBLISHABLE', merchandise_gmv_brl, null)) as gmv_categorias
           from categories group by 1"""
    ),
    "measures_delivery": sql(
        f"""select cast(sum(orders) as bigint) as ordenes_entrega,
                   cast(sum(if(delivery_status = 'LATE', orders, null)) as bigint) as ordenes_tardias,
                   round(sum(if(delivery_status = 'LATE', orders, null)) / nullif(sum(orders), 0), 9)
                       as tasa_tardia_publicable,
                   round({weighted('avg_review_score', 'reviewed_orders')}, 9) as review_ponderada,
                   round({weighted('avg_review_score', 'reviewed_orders', "delivery_status = 'ON_TIME'")}, 9)
                       as review_a_tiempo,
                   round({weighted('avg_review_score', 'reviewed_orders', "delivery_status = 'LATE'")}, 9)
                       as review_tardia
            from deliveries where coverage_status = 'PUBLISHABLE'"""
    ),
    "measures_delivery_by_month": sql(
        """, public as (select * from deliveries where coverage_status = 'PUBLISHABLE')
           select month_start, round(sum(if(delivery_status = 'LATE', p.orders, null)) / nullif(sum(p.orders), 0), 9)
                      as tasa_tardia_publicable
           from (select distinct month_start from deliveries) m left join public p using (month_start) group by 1"""
    ),
    "measures_delivery_by_status": sql(
        f"""select delivery_status,
                   round({weighted('avg_review_score', 'reviewed_orders', "coverage_status = 'PUBLISHABLE'")}, 9)
                       as review_ponderada
            from deliveries group by 1"""
    ),
    "measures_sellers": sql(
        f"""select count(distinct seller_id) as vendedores_publicables, sum(merchandise_gmv_brl) as gmv_vendedores,
                   round({weighted('late_delivery_rate', 'orders')}, 9) as tasa_tardia_vendedores
            from merchants where coverage_status = 'PUBLISHABLE'"""
    ),
    "measures_sellers_by_state": sql(
        f"""select seller_state,
                   round({weighted('late_delivery_rate', 'orders', "coverage_status = 'PUBLISHABLE'")}, 9)
                       as tasa_tardia_vendedores
            from merchants group by 1"""
    ),
    "measures_quality": sql(
        """select count(*) as controles, count(if(status = 'FAIL' and severity = 'HIGH', 1, null)) as fallas_altas,
                  count(if(status = 'FAIL' and severity = 'MEDIUM', 1, null)) as advertencias_medias,
                  round(count(if(status = 'PASS', 1, null)) / count(*), 9) as tasa_controles_aprobados,
                  round(sum(if(status = 'FAIL', observed_value, null)), 9) as valor_observado_fallas
           from checks"""
    ),
    "measures_quality_by_status": sql("select status, count(*) as controles from checks group by 1"),
    "suppressed_rows": sql(
        """select cast(sum(n) as bigint) as filas_suprimidas from (
               select count(*) as n from summary where coverage_status = 'SUPPRESSED'
               union all select count(*) from crossed where coverage_status = 'SUPPRESSED'
               union all select count(*) from affinity where coverage_status = 'SUPPRESSED'
               union all select count(*) from categories where coverage_status = 'SUPPRESSED'
               union all select count(*) from deliveries where coverage_status = 'SUPPRESSED'
               union all select count(*) from merchants where coverage_status = 'SUPPRESSED')"""
    ),
    "ingest_row_counts": sql(
        """select 'raw_customers' as source_table, count(*) as source_rows from people
           union all select 'raw_geolocation', count(*) from customer
           union all select 'raw_order_items', count(*) from lineitem
           union all select 'raw_order_payments', count(*) from lineitem
           union all select 'raw_order_reviews', count(*) from events
           union all select 'raw_orders', count(*) from orders
           union all select 'raw_products', count(*) from part
           union all select 'raw_sellers', count(*) from supplier
           union all select 'raw_product_category_name_translation', count(distinct p_type) - 1 from part"""
    ),
    "ingest_state": sql(
        """select '1.0.0' as schema_version, 9 as source_tables,
                  (select count(*) from people) + (select count(*) from customer)
                  + 2 * (select count(*) from lineitem) + (select count(*) from events)
                  + (select count(*) from orders) + (select count(*) from part) + (select count(*) from supplier)
                  + (select count(distinct p_type) - 1 from part) as source_rows"""
    ),
    "ingested_order_items": sql(
        """select cast(order_id as varchar) as order_id, order_item_id, cast(product_id as varchar) as product_id,
                  cast(seller_id as varchar) as seller_id, shipping_limit_at, price as item_value_brl,
                  freight as freight_value_brl from sold"""
    ),
    "pipeline_seller_performance_in_buckets": sql(
        SELLER.replace("'build-0' as build_id, ", "").replace(" seller_id,", " cast(seller_id as varchar) as seller_id,")
    ),
    "pipeline_segment_summary": sql(SUMMARY.replace("'build-0' as build_id, ", "")),
    "published_roundtrip": sql(
        f"""select {TAGS}, cast(seller_id as varchar) as seller_id, seller_state, orders, units,
                   cast(merchandise_gmv_brl as double) as merchandise_gmv_brl,
                   {r('avg_review_score', 'late_delivery_rate')}, coverage_status
            from merchants where coverage_status = 'PUBLISHABLE'"""
    ),
    "gate_of_a_run": sql(
        """select count(*) as checks,
                  count(case when status = 'FAIL' and severity = 'HIGH' then 1 end) as high_failures,
                  count(case when status = 'FAIL' and severity = 'MEDIUM' then 1 end) as medium_warnings,
                  count(case when status = 'FAIL' and severity = 'HIGH' then 1 end) = 0 as exported
           from checks"""
    ),
    "exported_tables": sql(
        " union all ".join(
            f"""select 0 as high_failures, '{table}' as table_name, count(*) as manifest_rows, count(*) as csv_rows,
                       count(*) as spreadsheet_rows, count(case when {public} then 1 end) as public_rows
                from {view}"""
            for table, view, public in (
                ("executive_monthly", "monthly", "true"),
                ("customer_segment_summary", "summary", "coverage_status = 'PUBLISHABLE'"),
                ("customer_cross_segment", "crossed", "coverage_status = 'PUBLISHABLE'"),
                ("customer_category_affinity", "affinity", "coverage_status = 'PUBLISHABLE'"),
                ("category_performance", "categories", "coverage_status = 'PUBLISHABLE'"),
                ("seller_performance", "merchants", "coverage_status = 'PUBLISHABLE'"),
                ("delivery_experience", "deliveries", "coverage_status = 'PUBLISHABLE'"),
                ("quality_checks", "checks", "true"),
            )
        )
    ),
    "exported_public_category_performance": sql(
        CATEGORY.replace("'build-0' as build_id, ", "").replace(
            "merchandise_gmv_brl,", "cast(merchandise_gmv_brl as double) as merchandise_gmv_brl,"
        )
        + ONLY_PUBLIC
    ),
    "run_outcomes": sql(
        """select * from (values
               ('second ingest', 'the same'),
               ('forced ingest', 'another'),
               ('forced rows', (select cast((select count(*) from people) + (select count(*) from customer)
                  + 2 * (select count(*) from lineitem) + (select count(*) from events)
                  + (select count(*) from orders) + (select count(*) from part) + (select count(*) from supplier)
                  + (select count(distinct p_type) - 1 from part) as varchar))),
               ('missing sources', 'Falta la fuente requerida: olist_orders_dataset.csv, olist_products_dataset.csv'),
               ('swapped columns',
                'Contrato incompatible en raw_sellers: esperado=[''seller_id'', ''seller_zip_code_prefix'', '
                    || '''seller_city'', ''seller_state''], recibido=[''seller_state'', ''seller_city'', '
                    || '''seller_zip_code_prefix'', ''seller_id'']'),
               ('ingest afterwards', 'kept'),
               ('overtaken ingest',
                'ingest: version 2 was committed since version 1, from which this run began'),
               ('tables', '31'),
               ('tables built', '31'),
               ('build time', 'True'),
               ('dashboard columns', 'accepted'),
               ('lacking columns', 'Faltan columnas en executive_monthly: as_of_date, units'),
               ('lacking table', 'Falta la tabla requerida del dashboard: executive_monthly')
           ) as told(outcome, said)"""
    ),
    "landed_digests": sql(
        """select part, octet_length(encode(content)) as bytes, sha256(content) as sha256
           from (select c_custkey // 500 as part,
                        string_agg(c_custkey || ',' || c_mktsegment || chr(10), '' order by c_custkey) as content
                 from customer group by 1)"""
    ),
}
