"""The same results in plain SQL, written from the definitions and not from the Spark code."""

from __future__ import annotations

import re

# the run is that of the last week on record
_MONDAY = "(SELECT date_trunc('week', max(l_shipdate)::DATE)::DATE FROM lineitem)"
RUN_PERIOD, THEN_PERIOD, YEAR_BEFORE = (f"CAST(yearweek({_MONDAY} - {days}) AS INT)" for days in (0, 14, 364))
MIDWEEK = f"({_MONDAY} + 4)"


def ending(x: str) -> str:
    """Cents digit table below 100, whole numbers from 100 on."""
    k = f"floor(({x})*100+0.5)"
    v = f"({k}/100)"
    n = f"floor({v}+0.5)"
    move = "WHEN 1 THEN -1 WHEN 2 THEN -2 WHEN 3 THEN 2 WHEN 4 THEN 1 WHEN 6 THEN -1 WHEN 7 THEN -2 WHEN 8 THEN 2 WHEN 9 THEN 1"
    digit = f"((CAST({k} AS BIGINT) % 10 + 10) % 10)"
    return (
        f"(CASE WHEN ({x}) < 100 THEN ({k} + CASE {digit} {move} ELSE 0 END)/100 "
        f"WHEN floor(({v}-{n})*10+0.5) < 5 THEN {n} ELSE {n}+1 END)"
    )


def cut(x: str, digits: int = 4) -> str:
    return f"CAST(floor(({x})*1e{digits} + 0.5 + 1e-5)/1e{digits} AS DOUBLE)"


def flag(price: str, ref: str, percent: str) -> str:
    return (
        f"CASE WHEN {price} IS NULL OR {ref} IS NULL OR {percent} IS NULL THEN NULL "
        f"WHEN {ref}-{price} > 0 AND 100*abs({ref}-{price})/{ref} >= {percent} THEN 1 ELSE 0 END"
    )


def gross(x: str) -> str:
    return f"({x} + {x}*(iva+ieps)/1000.0)"


def disc(p: float, x: str = "comp_price") -> str:
    return f"quantile_disc({x}, {p})"


_CENTS = "CAST(floor(l_extendedprice*100+0.5) AS BIGINT)"
_DISC = "CAST(floor(l_discount*100+0.5) AS BIGINT)"
_SUMS = f"""CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS units,
    CAST(sum({_CENTS}*(100-{_DISC})) AS BIGINT)/10000 AS amount,
    CAST(sum({_CENTS}) AS BIGINT)*7/1000 AS cost"""


def national(prefix: str, prices: str) -> str:
    return f"""
    SELECT upc, period, avg(comp_price) AS {prefix}_avg, stddev_samp(comp_price) AS {prefix}_std,
        {disc(0.5)} AS {prefix}_median, max(m.ending) AS {prefix}_mode, max(m.freq) AS {prefix}_mode_freq
    FROM {prices} JOIN (
        SELECT upc, period, ending, freq FROM (
            SELECT upc, period, {ending('comp_price')} AS ending, count(*) AS freq,
                row_number() OVER (PARTITION BY upc, period ORDER BY count(*) DESC, {ending('comp_price')}) AS k
            FROM {prices} GROUP BY upc, period, {ending('comp_price')}) WHERE k = 1
    ) m USING (upc, period)
    GROUP BY upc, period"""


def fact(sales: str, inventory_pairs: bool = False, fill: bool = True, weekly: bool = False) -> str:
    """The fact table over the sales view ``sales``; ``weekly``: what is known for each line's own week."""
    w = "_by_week" if weekly else ""
    same = (lambda a: f" AND {a}.period=l.period") if weekly else (lambda a: "")
    week = "period, " if weekly else ""
    base = (
        f"(SELECT DISTINCT store, sku FROM inventory) u LEFT JOIN {sales} s USING (store, sku)"
        if inventory_pairs
        else f"{sales} s"
    )

    def filled(p: str, m: str) -> str:
        return f"coalesce({p}, {m})" if fill else p

    ref = "hist_median"
    return f"""
    SELECT x.sku, x.upc, x.store, x.period, stock_units, stock_value, stock_cost, units, cost, amount, amount_gross,
        central_sales, central_sales_gross, comp_price*units AS comp_sales, comp_price_now*units AS comp_sales_now,
        amount_gross-cost AS margin_gross, central_sales_gross-cost AS central_margin_gross,
        comp_price*units-cost AS comp_margin, comp_price_now*units-cost AS comp_margin_now,
        avg_price, avg_price_gross, central_price, central_price_gross,
        comp_store, comp_chain, comp_source_original, comp_source, priority,
        comp_price, comp_price_now, comp_price_recent, recent_period,
        hist_avg, hist_std, hist_min, hist_max, hist_median, hist_p10, hist_p20, hist_p80, hist_p90,
        market_avg, market_std, market_median, market_mode,
        market_now_avg, market_now_std, market_now_median, market_now_mode,
        recent_market_period, recent_market_avg, recent_market_median, recent_market_mode,
        {flag('avg_price_gross', ref, '60')} AS clearance,
        {flag('comp_price', ref, '60')} AS comp_clearance,
        {flag('comp_price_now', ref, '60')} AS comp_clearance_now,
        {flag('avg_price_gross', ref, 'limit_pct')} AS promo,
        {flag('comp_price', ref, 'limit_pct')} AS comp_promo,
        {flag('comp_price_now', ref, 'limit_pct')} AS comp_promo_now,
        CASE WHEN ({flag('comp_price_recent', ref, 'limit_pct')}) = 0
            THEN {flag('comp_price_recent', 'recent_market_mode', '60')}
            ELSE {flag('comp_price_recent', ref, 'limit_pct')} END AS comp_promo_recent,
        units*(comp_price-avg_price_gross) AS cup, units*(comp_price-central_price_gross) AS cupc,
        comp_price_now-comp_price AS simulated_check_impact, avg_price_gross-central_price_gross AS real_check_impact,
        units*((comp_price_now-comp_price)-(avg_price_gross-central_price_gross)) AS cuic,
        units*(comp_price-central_price_gross)
            + units*((comp_price_now-comp_price)-(avg_price_gross-central_price_gross)) AS cut,
        comp_price_now*units-amount_gross AS comp_now_minus_sales,
        comp_price-hist_median AS comp_minus_hist_median, CAST(0.17 AS DOUBLE) AS target_margin,
        store_name, st.format, region, zone, store_type,
        k.description, k.status, k.dept, k.dept_name, k.subdept, k.subdept_name, k.class_id, k.subclass_id,
        store_decile, national_decile,
        format_price_avg, format_price_std, format_price_median, format_price_min, format_price_max,
        format_price_p05, format_price_p10, format_price_p90, format_price_p95
    FROM (
        SELECT *, {gross('amount')} AS amount_gross, {gross('avg_price')} AS avg_price_gross,
            {gross('central_price')} AS central_price_gross, central_price*units AS central_sales,
            {gross('(central_price*units)')} AS central_sales_gross,
            comp_source_raw AS comp_source_original,
            CASE WHEN comp_price_raw IS NULL THEN 'Moda' ELSE comp_source_raw END AS comp_source,
            {filled('comp_price_raw', 'market_mode')} AS comp_price,
            {filled('comp_price_now_raw', 'market_now_mode')} AS comp_price_now,
            CAST(coalesce(promo_percent, 20) AS DOUBLE) AS limit_pct
        FROM (
            SELECT l.*, b.comp_store, b.comp_source AS comp_source_raw, b.comp_chain, b.priority,
                t.comp_price AS comp_price_raw, n.comp_price AS comp_price_now_raw,
                rs.comp_price_recent, rs.recent_period, h.* EXCLUDE ({week}upc, comp_store, comp_source),
                na.* EXCLUDE ({week}upc), rn.* EXCLUDE ({week}upc), c.* EXCLUDE ({week}sku, store),
                x.iva, x.ieps, pl.promo_percent
            FROM {lines_of(base)} l
            JOIN ({best_of(lines_of(base), weekly)}) b USING ({week}store, upc, dept, subdept)
            LEFT JOIN ({_seen(2, weekly)}) t ON t.upc=l.upc AND t.comp_store=b.comp_store
                AND t.comp_source=b.comp_source{same('t')}
            LEFT JOIN ({_seen(0, weekly)}) n ON n.upc=l.upc AND n.comp_store=b.comp_store
                AND n.comp_source=b.comp_source{same('n')}
            LEFT JOIN recent_store{w} rs ON rs.upc=l.upc AND rs.comp_store=b.comp_store
                AND rs.comp_source=b.comp_source{same('rs')}
            LEFT JOIN store_history{w} h ON h.upc=l.upc AND h.comp_store=b.comp_store
                AND h.comp_source=b.comp_source{same('h')}
            LEFT JOIN national_run{w} na ON na.upc=l.upc{same('na')}
            LEFT JOIN recent_national{w} rn ON rn.upc=l.upc{same('rn')}
            LEFT JOIN central_asof{w} c ON c.sku=l.sku AND c.store=l.store{same('c')}
            JOIN taxes x ON x.sku=l.sku
            LEFT JOIN promo_limits pl ON pl.dept=l.dept AND pl.subdept=l.subdept
        )
    ) x
    JOIN stores st ON st.store=x.store
    LEFT JOIN skus k ON k.sku=x.sku
    LEFT JOIN store_deciles sd ON sd.sku=x.sku AND sd.store=x.store
    LEFT JOIN national_deciles nd ON nd.sku=x.sku
    LEFT JOIN ({format_stats(lines_of(base), week)}) fs
        ON fs.sku=x.sku AND fs.upc=x.upc AND fs.format=st.format{' AND fs.period=x.period' if weekly else ''}"""


def _seen(back: int, weekly: bool) -> str:
    """Prices of the week ``back`` weeks before the run, or before each week."""
    if weekly:
        return f"SELECT w.period, p.* EXCLUDE (period) FROM prices p JOIN windows w ON w.seen=p.period AND w.back={back}"
    return f"SELECT * FROM prices WHERE period={THEN_PERIOD if back else RUN_PERIOD}"


def lines_of(base: str) -> str:
    return f"""(SELECT s_.*, k.upc, k.dept, k.subdept, k.class_id, k.subclass_id,
        CASE WHEN units = 0 THEN NULL ELSE amount/units END AS avg_price
        FROM (SELECT * FROM {base}) s_ JOIN skus k USING (sku) WHERE k.upc IS NOT NULL)"""


def best_of(lines: str, weekly: bool = False) -> str:
    """Penalties row by row, then the minimum per store and UPC joined back."""
    week = "period, " if weekly else ""
    w = "_by_week" if weekly else ""
    same = (lambda a: f" AND {a}.period=l.period") if weekly else (lambda a: "")
    return f"""
    WITH penalised AS (
        SELECT DISTINCT {'l.period, ' if weekly else ''}l.store, l.upc, l.dept, l.subdept, m.comp_store, m.comp_source, m.comp_chain,
            m.priority + CASE WHEN t.upc IS NULL THEN 10000 ELSE 0 END
                + CASE WHEN n.upc IS NULL THEN 1000 ELSE 0 END
                + CASE WHEN r.upc IS NULL THEN 100 ELSE 0 END AS priority
        FROM {lines} l JOIN matrix m USING (store, dept, subdept)
        LEFT JOIN ({_seen(2, weekly)}) t
            ON t.upc=l.upc AND t.comp_store=m.comp_store AND t.comp_source=m.comp_source{same('t')}
        LEFT JOIN ({_seen(0, weekly)}) n
            ON n.upc=l.upc AND n.comp_store=m.comp_store AND n.comp_source=m.comp_source{same('n')}
        LEFT JOIN recent_store{w} r
            ON r.upc=l.upc AND r.comp_store=m.comp_store AND r.comp_source=m.comp_source{same('r')})
    SELECT p.* FROM penalised p
    JOIN (SELECT {week}store, upc, min(priority) AS priority FROM penalised GROUP BY {week}store, upc)
    USING ({week}store, upc, priority)"""


def format_stats(lines: str, week: str = "") -> str:
    a = "avg_price"
    return f"""
    SELECT {week}sku, upc, format, avg({a}) AS format_price_avg, stddev_samp({a}) AS format_price_std,
        {disc(.5, a)} AS format_price_median, min({a}) AS format_price_min, max({a}) AS format_price_max,
        {disc(.05, a)} AS format_price_p05, {disc(.1, a)} AS format_price_p10,
        {disc(.9, a)} AS format_price_p90, {disc(.95, a)} AS format_price_p95
    FROM {lines} JOIN stores USING (store) WHERE {a} <> 0 AND {a} IS NOT NULL GROUP BY {week}sku, upc, format"""


def single(fact_view: str, mode: bool = False, endings: bool = False) -> str:
    promo = "comp_promo_recent"
    if endings:
        promo = f"""CASE WHEN regexp_matches(CAST(comp_price_recent AS VARCHAR), '\\.0[1-3]$')
            AND comp_price_recent > recent_market_mode
            AND comp_chain IN ('WALMART CORPORATION', 'BODEGA AURRERA') THEN 1 ELSE comp_promo_recent END"""
    other, label = ("recent_market_mode", "'ModaNacional'") if mode else ("NULL", "NULL")
    return f"""
    SELECT *, CASE WHEN suggested_price IS NULL THEN NULL ELSE source_raw END AS suggested_source FROM (
        SELECT sku, upc, dept, subdept, store,
            CASE WHEN comp_price_recent IS NULL THEN {other} WHEN promo_ = 1 THEN {other}
                ELSE comp_price_recent END AS suggested_price,
            CASE WHEN comp_price_recent IS NULL THEN {label} WHEN promo_ = 1 THEN {label}
                ELSE 'PrecioPuntual' END AS source_raw,
            CASE WHEN comp_price_recent IS NULL OR coalesce(promo_, 0) = 1 THEN 10 ELSE priority % 100 END AS priority,
            comp_price_recent AS spot_price, comp_store, comp_chain, comp_source_original AS comp_source,
            hist_median AS store_median, recent_market_median AS national_median,
            recent_market_mode AS national_mode
        FROM (SELECT *, {promo} AS promo_ FROM {fact_view}))"""


def group_rows(single_sql: str) -> str:
    return f"""SELECT s.*, g.price_group, coalesce(pl.promo_percent, 20) AS promo_percent
        FROM ({single_sql}) s LEFT JOIN price_groups g USING (sku)
        LEFT JOIN promo_limits pl USING (dept, subdept)"""


def group_prices(rows: str, top: bool = True, drop_low: bool = True, pool: str = "all") -> str:
    """``rows`` is a view of group rows."""
    keyed = "price_group IS NOT NULL AND suggested_price IS NOT NULL"
    best = f"""(SELECT a.* FROM {rows} a JOIN (
        SELECT store, price_group, min(priority) AS priority FROM {rows} WHERE {keyed} GROUP BY store, price_group
        ) USING (store, price_group, priority))"""
    median_rows = best if top else rows
    low = flag("suggested_price", "med", "CAST(promo_percent AS DOUBLE)")
    keep = f"AND ({low}) <> 1" if drop_low else ""
    pool_rows = best if pool == "top_priority" else rows
    return f"""
    SELECT p.store, p.price_group, med AS group_store_median, group_price,
        o.sku AS group_sku, o.priority AS group_priority, o.comp_store AS group_comp_store,
        o.comp_chain AS group_comp_chain, o.comp_source AS group_comp_source
    FROM (
        SELECT store, price_group, any_value(med) AS med, min(suggested_price) AS group_price
        FROM {pool_rows} JOIN (
            SELECT store, price_group, {disc(.5, 'suggested_price')} AS med FROM {median_rows}
            WHERE {keyed} GROUP BY store, price_group) USING (store, price_group)
        WHERE suggested_price IS NOT NULL {keep} GROUP BY store, price_group) p
    JOIN (
        SELECT store, price_group, suggested_price, sku, priority, comp_store, comp_chain, comp_source,
            row_number() OVER (PARTITION BY store, price_group, suggested_price
                ORDER BY sku, priority, comp_store, comp_chain, comp_source) AS k
        FROM {rows} WHERE {keyed}) o
    ON o.store=p.store AND o.price_group=p.price_group AND o.suggested_price=p.group_price AND o.k=1"""


def suggested(fact_view: str, mode: bool = False, endings: bool = False, **options) -> str:
    rows = group_rows(single(fact_view, mode, endings))
    differs = "g_rows.price_group IS NOT NULL AND (suggested_price <> gp.group_price OR suggested_price IS NULL)"
    price = f"CASE WHEN {differs} THEN gp.group_price ELSE suggested_price END"
    source = f"CASE WHEN {differs} THEN 'PrecioGrupo' ELSE suggested_source END"
    if mode:
        source = f"CASE WHEN g_rows.price_group IS NOT NULL AND ({price}) IS NULL THEN 'ModaGrupo' ELSE {source} END"
        price = f"CASE WHEN g_rows.price_group IS NOT NULL AND ({price}) IS NULL THEN group_mode ELSE {price} END"
    return f"""
    WITH g_rows AS MATERIALIZED ({rows}), gp AS ({group_prices('g_rows', **options)})
    SELECT sku, upc, price_group, store, {ending('final_price')} AS suggested_price,
        CASE WHEN final_price IS NOT NULL THEN final_source END AS suggested_source, priority,
        spot_price, comp_store, comp_chain, comp_source, store_median, national_median, national_mode,
        group_price, group_median, group_mode, group_sku, group_priority, group_comp_store,
        group_comp_chain, group_comp_source, exception, group_exception_sku, group_exception
    FROM (
        SELECT g_rows.*, {price} AS final_price, {source} AS final_source, gp.group_price, group_median, group_mode,
            group_sku, group_priority, group_comp_store, group_comp_chain, group_comp_source
        FROM g_rows LEFT JOIN gp ON gp.store=g_rows.store AND gp.price_group=g_rows.price_group
        LEFT JOIN (SELECT price_group, min(national_median) AS group_median, min(national_mode) AS group_mode
            FROM g_rows GROUP BY price_group) gn ON gn.price_group=g_rows.price_group
    ) LEFT JOIN exceptions USING (sku)
    LEFT JOIN ({group_exceptions()}) ge USING (price_group)"""


def group_exceptions() -> str:
    return """SELECT price_group, min(sku) AS group_exception_sku, arg_min(exception, sku) AS group_exception
        FROM exceptions JOIN price_groups USING (sku) GROUP BY price_group"""


def filled(prices: str) -> str:
    """Contingency prices as three lookups named med, grp and con."""
    fields = "group_price, group_sku, group_priority, group_comp_store, group_comp_chain, group_comp_source"
    return f"""
    med AS (SELECT sku, national_median AS c_median, national_mode AS c_mode FROM (
        SELECT *, row_number() OVER (PARTITION BY sku ORDER BY national_median, national_mode) AS k
        FROM {prices} WHERE national_median IS NOT NULL) WHERE k=1),
    grp AS (SELECT price_group, store, {', '.join(f'{f} AS c_{f}' for f in fields.split(', '))} FROM (
        SELECT *, row_number() OVER (PARTITION BY price_group, store ORDER BY {fields}) AS k
        FROM {prices} WHERE group_price IS NOT NULL) WHERE k=1),
    con AS (SELECT price_group, group_median AS c_group_median, group_mode AS c_group_mode FROM (
        SELECT *, row_number() OVER (PARTITION BY price_group ORDER BY group_median, group_mode) AS k
        FROM {prices} WHERE group_median IS NOT NULL AND price_group IS NOT NULL) WHERE k=1)"""


def fall_back(mode: bool) -> tuple[str, str]:
    price = "CASE WHEN suggested_price IS NULL THEN group_price ELSE suggested_price END"
    source = "CASE WHEN suggested_price IS NULL THEN 'PrecioGrupo' ELSE suggested_source END"
    if mode:
        for column, name in (("group_mode", "ModaGrupo"), ("national_mode", "ModaNacional")):
            source = f"CASE WHEN ({price}) IS NULL THEN '{name}' ELSE {source} END"
            price = f"CASE WHEN ({price}) IS NULL THEN {column} ELSE {price} END"
    return price, source


def impact(prices: str, how: str, mode: bool, stock: str = "snapshot") -> str:
    price, source = fall_back(mode)
    c_gross = ending(f"({ending('stock_value/stock_units')} + {ending('stock_value/stock_units')}*(iva+ieps)/1000.0)")
    a = "(CASE WHEN units <= 0 OR amount <= 0 THEN NULL ELSE amount/units END)"
    group_fields = "group_price group_sku group_priority group_comp_store group_comp_chain group_comp_source".split()
    return f"""
    WITH p_in AS MATERIALIZED (SELECT * FROM {prices}), {filled('p_in')},
    stock AS (
        SELECT sku, store, stock_units, stock_value, {c_gross} AS central_price_gross
        FROM {stock} LEFT JOIN taxes USING (sku)
        WHERE (store < 300 OR store > 499) AND store <> 686 AND store <> 687),
    sold AS (
        SELECT sku, store, {ending(gross(a))} AS avg_price_gross
        FROM total_sales LEFT JOIN taxes USING (sku)),
    joined AS (
        SELECT sku, store, stock_units, stock_value, central_price_gross, avg_price_gross, g.price_group,
            p.upc, p.suggested_price, p.suggested_source, p.priority, p.spot_price, p.comp_store, p.comp_chain,
            p.comp_source, p.store_median,
            coalesce(p.national_median, c_median) AS national_median,
            coalesce(p.national_mode, c_mode) AS national_mode,
            coalesce(p.group_median, c_group_median) AS group_median,
            coalesce(p.group_mode, c_group_mode) AS group_mode,
            {', '.join(f'coalesce(p.{f}, c_{f}) AS {f}' for f in group_fields)}
        FROM (SELECT * FROM stock {how} JOIN sold USING (sku, store))
        LEFT JOIN price_groups g USING (sku)
        LEFT JOIN (SELECT * EXCLUDE (price_group) FROM p_in) p USING (sku, store)
        LEFT JOIN med USING (sku)
        LEFT JOIN grp ON grp.price_group=g.price_group AND grp.store=store
        LEFT JOIN con ON con.price_group=g.price_group),
    priced AS (
        SELECT * EXCLUDE (suggested_price, suggested_source, central_price_gross, avg_price_gross),
            {ending('central_price_gross')} AS central_price_gross, {ending('avg_price_gross')} AS avg_price_gross,
            {ending(price)} AS suggested_price,
            CASE WHEN ({price}) IS NULL THEN NULL ELSE {source} END AS suggested_source
        FROM joined)
    SELECT priced.*, stock_units*(suggested_price-central_price_gross) AS impact_vs_central,
        stock_units*(suggested_price-avg_price_gross) AS impact_vs_average,
        ge.group_exception_sku, ge.group_exception, e.exception, k.* EXCLUDE (sku, upc), nd.national_decile,
        st.* EXCLUDE (store)
    FROM priced
    LEFT JOIN ({stock_exceptions(stock)}) ge ON ge.price_group=priced.price_group
    LEFT JOIN exceptions e ON e.sku=priced.sku
    LEFT JOIN skus k ON k.sku=priced.sku
    LEFT JOIN national_deciles nd ON nd.sku=priced.sku
    LEFT JOIN stores st ON st.store=priced.store
    WHERE e.exception IS NULL AND ge.group_exception IS NULL AND k.status <> 'P' AND k.status <> 'AT'"""


def stock_exceptions(stock: str = "snapshot") -> str:
    return f"""SELECT price_group, min(sku) AS group_exception_sku, arg_min(exception, sku) AS group_exception
        FROM exceptions JOIN price_groups USING (sku)
        WHERE exception IS NOT NULL AND sku IN (SELECT sku FROM {stock}) GROUP BY price_group"""


# Named views, put in front of a query when it uses them.
VIEWS: dict[str, str] = {
    "prices": """SELECT yearweek(l_shipdate)::INT AS period, l_partkey//10 AS upc,
        (l_suppkey%20)::INT AS comp_store, min(floor(l_extendedprice/l_quantity*100+0.5))/100 AS comp_price,
        'S'||CAST(l_suppkey%20%3 AS VARCHAR) AS comp_source
        FROM lineitem WHERE l_returnflag<>'R' GROUP BY ALL""",
    "sales": f"""SELECT yearweek(l_shipdate)::INT AS period, l_partkey AS sku, (l_suppkey%20)::INT AS store, {_SUMS}
        FROM lineitem WHERE l_returnflag='R' GROUP BY ALL""",
    "total_sales": f"""SELECT l_partkey AS sku, (l_suppkey%20)::INT AS store, {_SUMS}, {RUN_PERIOD} AS period
        FROM lineitem WHERE l_returnflag='R' GROUP BY l_partkey, l_suppkey%20""",
    "inventory": f"""SELECT l_partkey AS sku, (l_suppkey%20)::INT AS store, l_shipdate::DATE AS stock_date,
        CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS stock_units,
        CAST(sum({_CENTS}) AS BIGINT)/100 AS stock_value, CAST(sum({_CENTS}) AS BIGINT)*7/1000 AS stock_cost
        FROM lineitem GROUP BY ALL""",
    "snapshot": f"""SELECT sku, store, {MIDWEEK} AS stock_date, stock_units, stock_value, stock_cost FROM inventory
        WHERE (sku, store, stock_date) IN (SELECT (sku, store, max(stock_date)) FROM inventory
        WHERE stock_date <= {MIDWEEK} GROUP BY sku, store)""",
    "newest_stock": """SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (
        PARTITION BY sku, store ORDER BY stock_date DESC NULLS LAST) AS k FROM inventory) WHERE k=1""",
    "stores": """SELECT store, store_name, format, region, zone, store_type FROM (
        SELECT (s_suppkey%20)::INT AS store, s_name AS store_name, r_name AS format, n_name AS region,
            'Z'||CAST(s_nationkey%4 AS VARCHAR) AS zone,
            CASE WHEN s_acctbal<0 THEN 'EXPRESS' ELSE 'NORMAL' END AS store_type,
            row_number() OVER (PARTITION BY s_suppkey%20 ORDER BY s_suppkey) AS k
        FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey) WHERE k=1""",
    "skus": """SELECT p_partkey AS sku, p_partkey//10 AS upc, p_name AS description,
        CASE p_size WHEN 49 THEN 'P' WHEN 48 THEN 'AT' ELSE 'A' END AS status,
        p_type AS dept, 'Dept '||p_type AS dept_name, p_brand AS subdept, 'Sub '||p_brand AS subdept_name,
        p_size%5 AS class_id, p_size AS subclass_id FROM part""",
    "taxes": """SELECT p_partkey AS sku, CASE WHEN p_size%2=0 THEN 160.0 ELSE 0 END::DOUBLE AS iva,
        CASE WHEN p_size%5=0 THEN 80.0 ELSE 0 END::DOUBLE AS ieps FROM part WHERE p_size<>13""",
    "matrix": """SELECT DISTINCT store::INT AS store, priority::INT AS priority, p_type AS dept, p_brand AS subdept,
        ((store+priority)%20)::INT AS comp_store, 'S'||CAST((store+priority)%20%3 AS VARCHAR) AS comp_source,
        CASE (store+priority)%20%3 WHEN 0 THEN 'WALMART CORPORATION' WHEN 1 THEN 'BODEGA AURRERA'
            ELSE 'OTHER' END AS comp_chain
        FROM part, range(20) s(store), range(1, 4) p(priority) WHERE p_size<>50""",
    "promo_limits": "SELECT DISTINCT p_type AS dept, p_brand AS subdept, 10 AS promo_percent FROM part WHERE p_type='PROMO'",
    "price_groups": "SELECT p_partkey AS sku, CASE WHEN p_size%7<>0 THEN p_partkey//50 END AS price_group FROM part",
    "exceptions": "SELECT p_partkey AS sku, 'E' AS exception FROM part WHERE p_size=50 AND p_type='SMALL'",
    "store_deciles": """SELECT sku, store, store_decile FROM (
        SELECT l_partkey AS sku, (l_suppkey%20)::INT AS store, (floor(l_discount*100+0.5)+1)::INT AS store_decile,
            rank() OVER (PARTITION BY l_partkey, l_suppkey%20 ORDER BY l_shipdate::DATE DESC) AS k
        FROM lineitem WHERE l_returnflag='R') WHERE k=1""",
    "national_deciles": """SELECT l_partkey AS sku, l_partkey//10 AS upc,
        min(CAST(regexp_extract('NAC D'||CAST(CAST(l_quantity AS INT)%10+1 AS VARCHAR), 'D(\\d+)$', 1) AS INT))
            AS national_decile FROM lineitem GROUP BY ALL""",
    "all_week_stats": national("market", "prices"),
    "national_run": f"""SELECT a.upc, a.market_avg, a.market_std, a.market_median, a.market_mode, a.market_mode_freq,
        b.market_avg AS market_now_avg, b.market_std AS market_now_std, b.market_median AS market_now_median,
        b.market_mode AS market_now_mode, b.market_mode_freq AS market_now_mode_freq
        FROM all_week_stats a LEFT JOIN all_week_stats b ON a.upc=b.upc AND b.period={RUN_PERIOD}
        WHERE a.period={THEN_PERIOD}""",
    "store_history": f"""SELECT upc, comp_store, comp_source, avg(comp_price) AS hist_avg,
        stddev_samp(comp_price) AS hist_std, min(comp_price) AS hist_min, max(comp_price) AS hist_max,
        {disc(.5)} AS hist_median, {disc(.1)} AS hist_p10, {disc(.2)} AS hist_p20, {disc(.8)} AS hist_p80,
        {disc(.9)} AS hist_p90 FROM prices GROUP BY upc, comp_store, comp_source""",
    "recent_national": """SELECT upc, period AS recent_market_period, market_avg AS recent_market_avg,
        market_median AS recent_market_median, market_mode AS recent_market_mode,
        market_mode_freq AS recent_market_mode_freq
        FROM all_week_stats JOIN (SELECT upc, max(period) AS period FROM prices GROUP BY upc) USING (upc, period)""",
    "recent_store": """SELECT upc, comp_store, comp_source, period AS recent_period, comp_price AS comp_price_recent
        FROM (SELECT *, rank() OVER (PARTITION BY upc, comp_store, comp_source ORDER BY period DESC) AS k
        FROM prices) WHERE k=1""",
    "central_asof": f"""SELECT sku, store,
        CASE WHEN stock_units=0 THEN NULL ELSE stock_value/stock_units END AS central_price,
        stock_units, stock_value, stock_cost FROM (
        SELECT *, rank() OVER (PARTITION BY sku, store ORDER BY stock_date DESC) AS k FROM inventory
        WHERE stock_date <= {MIDWEEK}) WHERE k=1""",
    "windows": f"""SELECT period, back, CAST(yearweek(strptime(period::VARCHAR || '-1', '%G%V-%u') - to_days((7*back)::INT)) AS INT) AS seen
        FROM (SELECT DISTINCT period FROM sales), (SELECT unnest(range(0, 7))::INT AS back)""",
    "prices_by_week": "SELECT w.period, p.period AS seen, p.* EXCLUDE (period) FROM prices p JOIN windows w ON w.seen=p.period",
    "store_history_by_week": f"""SELECT period, upc, comp_store, comp_source, avg(comp_price) AS hist_avg,
        stddev_samp(comp_price) AS hist_std, min(comp_price) AS hist_min, max(comp_price) AS hist_max,
        {disc(.5)} AS hist_median, {disc(.1)} AS hist_p10, {disc(.2)} AS hist_p20, {disc(.8)} AS hist_p80,
        {disc(.9)} AS hist_p90 FROM prices_by_week GROUP BY period, upc, comp_store, comp_source""",
    "recent_store_by_week": """SELECT period, upc, comp_store, comp_source, seen AS recent_period, comp_price AS comp_price_recent
        FROM (SELECT *, rank() OVER (PARTITION BY period, upc, comp_store, comp_source ORDER BY seen DESC) AS k
        FROM prices_by_week) WHERE k=1""",
    "national_run_by_week": """SELECT w.period, a.upc, a.market_avg, a.market_std, a.market_median, a.market_mode, a.market_mode_freq,
        b.market_avg AS market_now_avg, b.market_std AS market_now_std, b.market_median AS market_now_median,
        b.market_mode AS market_now_mode, b.market_mode_freq AS market_now_mode_freq
        FROM windows w JOIN all_week_stats a ON a.period=w.seen
        LEFT JOIN all_week_stats b ON a.upc=b.upc AND b.period=w.period WHERE w.back=2""",
    "recent_national_by_week": """SELECT l.period, l.upc, s.period AS recent_market_period, market_avg AS recent_market_avg,
        market_median AS recent_market_median, market_mode AS recent_market_mode,
        market_mode_freq AS recent_market_mode_freq
        FROM (SELECT period, upc, max(seen) AS seen FROM prices_by_week GROUP BY period, upc) l
        JOIN all_week_stats s ON s.upc=l.upc AND s.period=l.seen""",
    "stock_by_week": """SELECT * EXCLUDE (k) FROM (
        SELECT s.period, i.*, rank() OVER (PARTITION BY s.period, i.sku, i.store ORDER BY stock_date DESC) AS k
        FROM (SELECT DISTINCT sku, store, period FROM sales) s JOIN inventory i
        ON i.sku=s.sku AND i.store=s.store AND i.stock_date <= strptime(s.period::VARCHAR || '-5', '%G%V-%u')::DATE) WHERE k=1""",
    "central_asof_by_week": """SELECT period, sku, store,
        CASE WHEN stock_units=0 THEN NULL ELSE stock_value/stock_units END AS central_price,
        stock_units, stock_value, stock_cost FROM stock_by_week""",
    "fact": fact("total_sales"),
    "weekly_fact": fact("sales", weekly=True),
    "fact_inventory": fact("total_sales", inventory_pairs=True, fill=False),
    "suggested": suggested("fact"),
    "suggested_with_modes": suggested("fact", mode=True),
    "impact": impact("suggested", "LEFT", False),
    "impact_newest": impact("suggested", "LEFT", False, "newest_stock"),
    "impact_newest_full": impact("suggested_with_modes", "FULL", True, "newest_stock"),
    "impact_full": impact("suggested_with_modes", "FULL", True),
    "group_input": group_rows(single("fact")),
    "sales_h": "SELECT s.*, k.upc, k.dept, k.subdept, k.class_id, k.subclass_id FROM sales s JOIN skus k USING (sku)",
    "taxed": f"""SELECT *, {gross('amount')} AS amount_gross, {gross('price_')} AS price_gross FROM (
        SELECT s.*, x.iva, x.ieps, CASE WHEN units=0 THEN NULL ELSE amount/units END AS price_
        FROM sales_h s JOIN taxes x USING (sku))""",
    "week_totals": """SELECT sku, store, dept, subdept, class_id, subclass_id, total_amount, total_units FROM (
        SELECT sku, store, CAST(sum(CAST(floor(amount*10000+0.5) AS BIGINT)) AS BIGINT)/10000 AS total_amount,
            sum(units) AS total_units FROM sales GROUP BY sku, store) LEFT JOIN skus USING (sku)""",
    "rolled": f"""SELECT period, region, dept, subdept, national_decile, clearance, comp_clearance_now, promo,
        comp_promo_now, min(dept_name) AS dept_name, min(subdept_name) AS subdept_name,
        {', '.join(f'sum({c}) AS sum_{c}' for c in
            'amount amount_gross comp_sales comp_sales_now comp_now_minus_sales units'.split())},
        count(DISTINCT upc) AS articles, count(DISTINCT store) AS stores FROM weekly_fact GROUP BY ALL""",
}


def _cut_columns(view: str, four: str = "", two: str = "") -> str:
    replaced = [f"{cut(c)} AS {c}" for c in four.split()] + [f"{cut(c, 2)} AS {c}" for c in two.split()]
    return f"SELECT * REPLACE ({', '.join(replaced)}) FROM {view}"


_IMPACTS = "impact_vs_central impact_vs_average"
_STATS = "hist_avg hist_std market_avg market_std market_now_avg market_now_std recent_market_avg"


def change_distribution(keys: str) -> str:
    q = ", ".join(f"quantile_disc(q, {p}) AS p{name}" for p, name in ((0, "00"), (0.1, "10"), (0.2, "20"), (0.8, "80"), (0.9, "90")))
    return f"""SELECT {keys}, min(dept_name) AS dept_name, {cut('avg(q)')} AS change_avg, min(q) AS change_min,
        max(q) AS change_max, {q} FROM (
        SELECT *, (CASE WHEN units=0 THEN NULL ELSE comp_sales_now/units END - hist_median)
            / CASE WHEN hist_median=0 THEN NULL ELSE hist_median END AS q FROM weekly_fact)
        GROUP BY {keys}"""


def shares(group: str, value: str, prefix: str, columns: str) -> str:
    digits = 4 if prefix == "amount" else None
    total = f"sum({value}) OVER (PARTITION BY {group})"
    run = f"""sum({value}) OVER (PARTITION BY {group} ORDER BY {value} DESC, sku, store
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    shown = (lambda x: cut(x, digits)) if digits else (lambda x: x)
    return f"""SELECT {columns}, {shown(total)} AS {prefix}_total, {shown(run)} AS {prefix}_running,
        {cut(f'{run} / {total}')} AS {prefix}_share FROM week_totals WHERE total_amount > 0"""


def deciles() -> str:
    levels = ["dept", "subdept", "class_id", "subclass_id"]
    columns = []
    for measure in ("total_amount", "total_units"):
        for depth, level in enumerate(levels, start=1):
            keys = ", ".join(["store", *levels[:depth]])
            reached = " + ".join(
                f"CASE WHEN {measure} >= quantile_disc({measure}, 0.{i}) OVER (PARTITION BY {keys}) THEN 1 ELSE 0 END"
                for i in range(1, 10)
            )
            columns.append(f"10 - ({reached}) AS {measure}_decile_{level}")
    return f"""SELECT * REPLACE ({cut('total_amount')} AS total_amount), {', '.join(columns)}
        FROM week_totals WHERE total_amount > 0"""


def shift(back: int) -> str:
    monday = "(make_date(period//100, 1, 4) - CAST(isodow(make_date(period//100, 1, 4))-1 AS INT) + 7*(period%100-1))"
    return f"CAST(yearweek({monday} - {7 * back}) AS INT)"


def name_join() -> str:
    return """SELECT m.store, m.n AS comp_name_in_matrix, f.n AS comp_name_in_feeds FROM (
        SELECT store, comp_source||'-'||comp_store AS n FROM matrix) m LEFT JOIN (
        SELECT DISTINCT comp_source||'-'||comp_store AS n FROM prices WHERE comp_source IN ('S0', 'S1')) f
        ON m.n=f.n"""


_FACT_METRICS = """sku, store, avg_price, avg_price_gross, central_price_gross, amount_gross, central_sales,
    central_sales_gross, comp_sales, comp_sales_now, margin_gross, central_margin_gross, comp_margin,
    comp_margin_now, cup, cupc, simulated_check_impact, real_check_impact, cuic, cut, comp_now_minus_sales,
    comp_minus_hist_median, clearance, comp_clearance, comp_clearance_now, promo, comp_promo, comp_promo_now,
    comp_promo_recent, target_margin, priority, comp_store"""

def coverage(view: str) -> str:
    return f"""SELECT store, dept, subdept, count(suggested_price) AS priced,
    count(*)-count(suggested_price) AS unpriced,
    {', '.join(f"{cut(f'sum({c}) FILTER (suggested_price IS NOT NULL)', 2)} AS {c}" for c in _IMPACTS.split())},
    CAST(floor(100.0*count(suggested_price)/count(*)+0.5) AS BIGINT) AS percent_regulated
    FROM {view} GROUP BY store, dept, subdept"""


_EN_ES = "replace(replace(replace(replace(strftime(stock_date, '%d%b%y'), 'Jan', 'Ene'), 'Apr', 'Abr'), 'Aug', 'Ago'), 'Dec', 'Dic')"

SQL: dict[str, str] = {
    "scan_delimited": "SELECT sku, upc, description, status FROM skus",
    "weekly_sales": "SELECT * FROM sales",
    "competitor_prices": "SELECT * FROM prices",
    "competitor_prices_multiweek": f"SELECT * FROM prices WHERE period BETWEEN {YEAR_BEFORE} AND {RUN_PERIOD}",
    "union_periods": "SELECT * FROM sales",
    "feed_inventory": "SELECT DISTINCT comp_source||period||'.csv' AS file, comp_source AS source, period FROM prices",
    "inventory_read": """SELECT * REPLACE (CASE WHEN sku%3=0 THEN '2001-11-02' ELSE CAST(stock_date AS VARCHAR) END AS stock_date)
        FROM inventory""",
    "latest_snapshot": f"""SELECT 'Inven_'||{_EN_ES}||'.csv' AS file, CAST(stock_date AS VARCHAR) AS snapshot_date,
        sku, store, stock_units FROM inventory
        WHERE stock_date = (SELECT max(stock_date) FROM inventory WHERE stock_date <= DATE '2000-06-15')""",
    "save_load_roundtrip": "SELECT * FROM sales",
    "split_export": "SELECT * FROM sales_h",
    "export_report": "SELECT * FROM sales",
    "competitor_store_catalogue": "SELECT DISTINCT comp_store FROM prices WHERE comp_source='S1'",
    "dim_stores": "SELECT * FROM stores",
    "dim_skus": "SELECT * FROM skus",
    "dim_store_deciles_latest": "SELECT * FROM store_deciles",
    "dim_national_deciles": "SELECT * FROM national_deciles",
    "dim_taxes": "SELECT * FROM taxes",
    "dim_competition_matrix": "SELECT * FROM matrix",
    "dim_promo_limits": "SELECT * FROM promo_limits",
    "dim_price_groups": "SELECT * FROM price_groups",
    "dim_exceptions": "SELECT * FROM exceptions",
    "restricted_extract": """SELECT * FROM sales WHERE sku IN (SELECT sku FROM skus WHERE status='AT')
        AND store IN (SELECT store FROM stores WHERE format='ASIA')""",
    "store_scope_filter": """SELECT CAST(l_suppkey*7%1000 AS INT) AS store, count(*) AS n FROM lineitem
        WHERE (l_suppkey*7%1000 < 300 OR l_suppkey*7%1000 > 499) AND l_suppkey*7%1000 NOT IN (686, 687) GROUP BY 1""",
    "exception_split": """SELECT sku, store, suggested_price, CASE WHEN exception IS NULL AND group_exception IS NULL
        THEN 'regular' ELSE 'exceptional' END AS part FROM suggested""",
    "fact_metrics": f"SELECT {_FACT_METRICS} FROM fact",
    "fallback_cascade": """SELECT sku, store,
        CASE WHEN suggested_source='PrecioPuntual' THEN suggested_price WHEN group_priority=1 THEN group_price
            WHEN group_mode IS NOT NULL THEN group_mode ELSE national_mode END AS suggested_price,
        CASE WHEN suggested_source='PrecioPuntual' THEN suggested_source
            WHEN group_priority=1 AND group_price IS NOT NULL THEN 'PrecioGrupo'
            WHEN group_mode IS NOT NULL THEN 'ModaGrupo' WHEN national_mode IS NOT NULL THEN 'ModaNacional' END
            AS suggested_source FROM suggested_with_modes""",
    "join_inner_sales_stores": "SELECT period, sku, store, format, region, units, amount FROM sales JOIN stores USING (store)",
    "join_left_prices": """SELECT s.period, s.sku, s.upc, s.store, s.amount, p.comp_price FROM sales_h s
        LEFT JOIN prices p ON p.period=s.period AND p.upc=s.upc AND p.comp_store=s.store""",
    "join_full_inventory_sales": """SELECT sku, store, stock_date, units, amount FROM (
        SELECT sku, store, CAST(max(stock_date) AS VARCHAR) AS stock_date FROM inventory GROUP BY sku, store)
        FULL JOIN total_sales USING (sku, store)""",
    "latest_price_per_store": "SELECT * FROM recent_store",
    "matrix_expand": """SELECT sku, upc, store, dept, subdept, priority, comp_store, comp_source, amount
        FROM total_sales JOIN skus USING (sku) JOIN matrix USING (store, dept, subdept)""",
    "priority_pick": f"""SELECT l.sku, l.upc, l.store, b.comp_store, b.comp_source, b.priority,
        b.priority % 100 AS base_priority, {ending('r.comp_price_recent')} AS price
        FROM {lines_of('total_sales')} l JOIN ({best_of(lines_of('total_sales'))}) b USING (store, upc, dept, subdept)
        LEFT JOIN recent_store r ON r.upc=l.upc AND r.comp_store=b.comp_store AND r.comp_source=b.comp_source""",
    "asof_inventory": f"""SELECT sku, store, CAST(stock_date AS VARCHAR) AS stock_date, stock_units, stock_value,
        stock_cost FROM inventory JOIN (SELECT sku, store, max(stock_date) AS stock_date FROM inventory
        WHERE stock_date <= {MIDWEEK} GROUP BY sku, store) USING (sku, store, stock_date)""",
    "store_membership": """SELECT CAST(coalesce(a.s, b.s) AS INT) AS store, CASE WHEN b.s IS NULL THEN 'left'
        WHEN a.s IS NULL THEN 'right' ELSE 'both' END AS found_in
        FROM (SELECT DISTINCT l_suppkey AS s FROM lineitem WHERE l_returnflag='R') a
        FULL JOIN (SELECT DISTINCT c_custkey*3 AS s FROM customer) b ON a.s=b.s""",
    "join_retention_funnel": f"""SELECT count(DISTINCT s.store) AS stores_with_sales,
        count(DISTINCT m.store) AS stores_in_matrix,
        count(DISTINCT CASE WHEN n.upc IS NOT NULL THEN m.store END) AS stores_with_prices_now,
        count(DISTINCT CASE WHEN n.upc IS NOT NULL AND t.upc IS NOT NULL THEN m.store END) AS stores_with_both_weeks
        FROM sales_h s LEFT JOIN matrix m ON m.store=s.store AND m.dept=s.dept AND m.subdept=s.subdept
        LEFT JOIN prices n ON n.upc=s.upc AND n.comp_store=m.comp_store AND n.comp_source=m.comp_source
            AND n.period={RUN_PERIOD}
        LEFT JOIN prices t ON t.upc=s.upc AND t.comp_store=m.comp_store AND t.comp_source=m.comp_source
            AND t.period={THEN_PERIOD}""",
    "contingency_fill": f"""WITH {filled('suggested')}
        SELECT i.sku, i.store, g.price_group, coalesce(p.national_median, c_median) AS national_median,
            coalesce(p.national_mode, c_mode) AS national_mode, coalesce(p.group_price, c_group_price) AS group_price,
            coalesce(p.group_sku, c_group_sku) AS group_sku,
            coalesce(p.group_priority, c_group_priority) AS group_priority,
            coalesce(p.group_comp_store, c_group_comp_store) AS group_comp_store,
            coalesce(p.group_median, c_group_median) AS group_median,
            coalesce(p.group_mode, c_group_mode) AS group_mode
        FROM (SELECT DISTINCT sku, store FROM inventory) i LEFT JOIN price_groups g ON g.sku=i.sku
        LEFT JOIN suggested p ON p.sku=i.sku AND p.store=i.store LEFT JOIN med ON med.sku=i.sku
        LEFT JOIN grp ON grp.price_group=g.price_group AND grp.store=i.store
        LEFT JOIN con ON con.price_group=g.price_group""",
    "group_price": f"SELECT store, price_group, group_store_median, group_price FROM ({group_prices('group_input')})",
    "group_price_top_priority": f"""SELECT store, price_group, group_store_median, group_price
        FROM ({group_prices('group_input', pool='top_priority')})""",
    "group_price_provenance": f"SELECT * EXCLUDE (group_store_median) FROM ({group_prices('group_input')})",
    "store_name_reconcile": name_join(),
    "store_name_reconcile_all_feeds": """SELECT m.store, m.comp_source||'-'||m.comp_store AS comp_name_in_matrix,
        any_value(p.comp_source||'-'||p.comp_store) AS comp_name_in_feeds
        FROM (SELECT *, row_number() OVER () AS n FROM matrix) m
        LEFT JOIN prices p ON m.comp_source=p.comp_source AND m.comp_store=p.comp_store GROUP BY m.n, m.store, m.comp_source, m.comp_store""",
    "inventory_universe": """SELECT store, sku, units, amount FROM (SELECT DISTINCT store, sku FROM inventory)
        LEFT JOIN total_sales USING (store, sku)""",
    "national_price_stats": _cut_columns("all_week_stats", "market_avg market_std"),
    "national_price_stats_two_periods": f"""SELECT a.upc, {shift(-2).replace('period', 'a.period')} AS period,
        {cut('a.market_avg')} AS market_avg, {cut('a.market_std')} AS market_std, a.market_median, a.market_mode,
        a.market_mode_freq, {cut('b.market_avg')} AS market_now_avg, {cut('b.market_std')} AS market_now_std,
        b.market_median AS market_now_median, b.market_mode AS market_now_mode,
        b.market_mode_freq AS market_now_mode_freq
        FROM all_week_stats a LEFT JOIN all_week_stats b
        ON a.upc=b.upc AND a.period={shift(2).replace('period', 'b.period')}""",
    "store_price_history": _cut_columns("store_history", "hist_avg hist_std"),
    "rounded_mode": f"""SELECT upc, arg_min(e, e) FILTER (n = m) AS price_mode, max(n) AS price_mode_freq FROM (
        SELECT *, max(n) OVER (PARTITION BY upc) AS m FROM (
        SELECT upc, {ending('comp_price')} AS e, count(*) AS n FROM prices GROUP BY ALL)) GROUP BY upc""",
    "observed_median": f"SELECT upc, {disc(.5)} AS price_median FROM prices GROUP BY upc",
    "recent_national_stats": _cut_columns("recent_national", "recent_market_avg"),
    "sales_price_stats_by_format": _cut_columns(
        f"({format_stats(lines_of('sales'))})", "format_price_avg format_price_std"
    ),
    "sales_sum_weeks": _cut_columns("week_totals", "total_amount"),
    "competitor_upcs": "SELECT DISTINCT upc FROM prices",
    "group_exceptions": group_exceptions(),
    "coverage_by_subdept": coverage("impact_full"),
    "coverage_by_subdept_both": f"SELECT * FROM ({coverage('impact')}) WHERE priced > 0 AND unpriced > 0",
    "regulated_counts": """SELECT store, dept, subdept, count(suggested_price) AS regulated, count(*) AS articles
        FROM impact_newest_full GROUP BY store, dept, subdept""",
    "impact_by_sku": f"""SELECT a.*, k.* EXCLUDE (sku, upc), national_decile FROM (
        SELECT sku, upc, {', '.join(f"{cut(f'sum({c})', 2)} AS {c}" for c in _IMPACTS.split())}
        FROM impact_full GROUP BY sku, upc) a LEFT JOIN skus k ON k.sku=a.sku
        LEFT JOIN national_deciles nd ON nd.sku=a.sku""",
    "impact_by_store": f"""SELECT * FROM (
        SELECT store, {', '.join(f"{cut(f'sum({c})', 2)} AS {c}" for c in _IMPACTS.split())}
        FROM impact_newest_full GROUP BY store) LEFT JOIN stores USING (store)""",
    "suggestion_counts": """SELECT store, CASE WHEN suggested_source='PrecioPuntual' THEN coalesce(priority, 0)
        ELSE 0 END AS priority, suggested_source, count(*) AS n FROM impact_full GROUP BY ALL""",
    "null_suggestion_skus": f"""SELECT a.sku, all_null, g.price_group, group_exception_sku, group_exception,
        k.* EXCLUDE (sku) FROM (
        SELECT sku, CASE WHEN count(suggested_price)=0 THEN 1 ELSE 0 END AS all_null FROM impact GROUP BY sku
        HAVING count(*) > count(suggested_price)) a
        LEFT JOIN price_groups g ON g.sku=a.sku LEFT JOIN ({stock_exceptions()}) ge ON ge.price_group=g.price_group
        LEFT JOIN skus k ON k.sku=a.sku""",
    "promo_fallback_report": """SELECT sku, store, suggested_price, suggested_source, spot_price, national_mode
        FROM impact_full WHERE suggested_source IN ('ModaNacional', 'MedianaNacional') AND spot_price IS NOT NULL""",
    "desc_counts": """SELECT period, count(DISTINCT store) AS stores, count(DISTINCT upc) AS articles
        FROM sales_h GROUP BY period""",
    "desc_stores": f"""SELECT * FROM (SELECT store, period, {cut('sum(amount)', 2)} AS amount,
        {cut('sum(amount_gross)', 2)} AS amount_gross, count(upc) AS articles FROM taxed GROUP BY store, period)
        LEFT JOIN stores USING (store)""",
    "desc_items": f"""SELECT sku, upc, period, {cut('sum(amount)', 2)} AS amount,
        {cut('sum(amount_gross)', 2)} AS amount_gross, count(store) AS stores, {cut('avg(price_gross)')} AS price_avg,
        min(price_gross) AS price_min, max(price_gross) AS price_max,
        {cut('coalesce(stddev_samp(price_gross), 0)')} AS price_std FROM taxed GROUP BY sku, upc, period""",
    "desc_minmax_stores": """SELECT sku, upc, period,
        string_agg(store::VARCHAR, ':' ORDER BY store) FILTER (price_gross = lo) AS stores_min,
        string_agg(store::VARCHAR, ':' ORDER BY store) FILTER (price_gross = hi) AS stores_max FROM (
        SELECT *, min(price_gross) OVER w AS lo, max(price_gross) OVER w AS hi FROM taxed
        WINDOW w AS (PARTITION BY sku, upc, period)) GROUP BY sku, upc, period""",
    "rollup_nine_keys": _cut_columns(
        "rolled", two="sum_amount sum_amount_gross sum_comp_sales sum_comp_sales_now sum_comp_now_minus_sales"
    ),
    "rollup_flags": f"""SELECT clearance, comp_clearance_now, promo, comp_promo_now,
        {cut('sum(sum_comp_now_minus_sales)', 2)} AS difference, 'all' AS level FROM rolled GROUP BY 1, 2, 3, 4
        UNION ALL SELECT NULL, NULL, promo, comp_promo_now, {cut('sum(sum_comp_now_minus_sales)/1e6', 2)}, 'promo'
        FROM rolled GROUP BY promo, comp_promo_now""",
    "price_change_distribution": change_distribution("period, dept, subdept"),
    "price_change_by_dept": change_distribution("dept"),
    "store_period_coverage": """SELECT store, period, rows FROM (
        SELECT store, period FROM stores, (SELECT DISTINCT period FROM sales))
        LEFT JOIN (SELECT store, period, count(*) AS rows FROM sales GROUP BY store, period) USING (store, period)""",
    "cumulative_share": shares("store", "total_amount", "amount", "sku, store"),
    "cumulative_share_subdept": shares(
        "store, dept, subdept", "total_amount", "amount", "sku, store, dept, subdept"
    ),
    "cumulative_share_units": shares(
        "store, dept, subdept, class_id", "total_units", "units", "sku, store, dept, subdept, class_id"
    ),
    "cumulative_share_class": shares(
        "store, dept, subdept, class_id", "total_amount", "amount", "sku, store, dept, subdept, class_id"
    ),
    "cumulative_share_units_store": shares("store", "total_units", "units", "sku, store"),
    "cumulative_share_units_subdept": shares(
        "store, dept, subdept", "total_units", "units", "sku, store, dept, subdept"
    ),
    "deciles_by_level": deciles(),
    "top_skus_per_decile": f"""SELECT decile, place, sku, {cut('sales', 2)} AS sales FROM (
        SELECT *, row_number() OVER (PARTITION BY decile ORDER BY sales DESC, sku) AS place FROM (
        SELECT sku, sum(amount_gross) AS sales, min(national_decile) AS decile FROM fact
        WHERE national_decile IS NOT NULL GROUP BY sku) WHERE decile BETWEEN 1 AND 5) WHERE place <= 2""",
    "top_stores": f"""SELECT store, min(comp_chain) AS comp_chain, {cut('sum(amount_gross)', 2)} AS sales
        FROM fact GROUP BY store ORDER BY sum(amount_gross) DESC, store LIMIT 20""",
    "store_sales_by_chain": f"""SELECT store, min(comp_chain) AS comp_chain, {cut('sum(amount_gross)', 2)} AS sales
        FROM fact GROUP BY store""",
    "price_rounding": f"""SELECT l_orderkey, l_linenumber, {ending('l_extendedprice/l_quantity')} AS unit_price,
        {ending('l_extendedprice/l_quantity/100')} AS low_price FROM lineitem""",
    "ending_flag": """SELECT *, CAST(CAST(floor(comp_price*100+0.5) AS BIGINT)%100 IN (1, 2, 3) AS INT) AS is_clearance
        FROM prices""",
    "yearweek_shift": f"""SELECT period, {', '.join(f'{shift(n)} AS back_{n}' for n in (1, 2, 6, 12, 52))},
        {shift(-1)} AS next_week FROM (SELECT DISTINCT yearweek(l_shipdate)::INT AS period FROM lineitem)""",
    "yearweek_midweek": """SELECT DISTINCT yearweek(l_shipdate)::INT AS period,
        CAST((date_trunc('week', l_shipdate) + INTERVAL 4 DAY)::DATE AS VARCHAR) AS midweek FROM lineitem""",
    "gross_price": f"SELECT period, sku, store, {gross('amount')} AS amount_gross FROM sales JOIN taxes USING (sku)",
    "promo_flag": f"""SELECT period, upc, comp_store, {flag('comp_price', 'med', '20')} AS promo,
        {flag('comp_price', 'med', '60')} AS clearance
        FROM prices JOIN (SELECT upc, {disc(.5)} AS med FROM prices GROUP BY upc) USING (upc)""",
    "competitor_stats": f"""SELECT * REPLACE ({', '.join(f'{cut(c)} AS {c}' for c in _STATS.split())})
        FROM store_history LEFT JOIN recent_store USING (upc, comp_store, comp_source)
        LEFT JOIN national_run USING (upc) LEFT JOIN recent_national USING (upc)""",
    "fact_table": _cut_columns("fact", _STATS + " format_price_avg format_price_std"),
    "weekly_competitor_stats": f"""SELECT * REPLACE ({', '.join(f'{cut(c)} AS {c}' for c in _STATS.split())})
        FROM store_history_by_week LEFT JOIN recent_store_by_week USING (period, upc, comp_store, comp_source)
        LEFT JOIN national_run_by_week USING (period, upc) LEFT JOIN recent_national_by_week USING (period, upc)""",
    "asof_inventory_by_week": "SELECT * REPLACE (CAST(stock_date AS VARCHAR) AS stock_date) FROM stock_by_week",
    "weekly_runs": _cut_columns("weekly_fact", _STATS + " format_price_avg format_price_std"),
    "weekly_reruns": "SELECT period, sku, store, comp_store, priority, units, comp_price FROM weekly_fact",
    "fact_table_inventory": _cut_columns("fact_inventory", _STATS + " format_price_avg format_price_std"),
    "suggested_prices": "SELECT * FROM suggested",
    "suggested_prices_national_mode": "SELECT * FROM suggested_with_modes",
    "suggested_prices_clearance_endings": suggested("fact", endings=True),
    "suggested_prices_all_priorities": suggested("fact", top=False),
    "suggested_prices_keep_low": suggested("fact", drop_low=False),
    "price_impact": "SELECT * FROM impact_newest",
    "weekly_chain": "SELECT * FROM impact",
    "price_impact_full": "SELECT * FROM impact_newest_full",
    "central_price_asof": "SELECT * FROM central_asof",
    "central_price_snapshot": """SELECT sku, store,
        CASE WHEN stock_units=0 THEN NULL ELSE stock_value/stock_units END AS central_price,
        stock_units, stock_value, stock_cost FROM snapshot""",
    "group_min_price": f"""WITH p AS MATERIALIZED (
        SELECT f.sku, f.store, g.price_group, coalesce(comp_price_recent, market_median) AS own
        FROM fact f LEFT JOIN price_groups g ON g.sku=f.sku)
        SELECT p.sku, p.price_group, p.store,
            {ending('CASE WHEN own > least_price OR own IS NULL THEN least_price ELSE own END')} AS suggested_price
        FROM p LEFT JOIN (SELECT store, price_group, min(own) AS least_price FROM p GROUP BY ALL) m
        ON m.store=p.store AND m.price_group=p.price_group""",
}


def _uses(text: str) -> set[str]:
    found = {name for name in VIEWS if re.search(rf"(?:FROM|JOIN|,)\s*\(?\s*{name}\b", text)}
    for name in list(found):
        found |= _uses(VIEWS[name])
    return found


def oracle(name: str) -> str:
    """The SQL of a query with the views it needs in front, in the order of their definition."""
    used = _uses(SQL[name])
    views = ",\n".join(f"{v} AS MATERIALIZED ({VIEWS[v]})" for v in VIEWS if v in used)
    return f"WITH {views}\nSELECT * FROM ({SQL[name]})" if views else SQL[name]
