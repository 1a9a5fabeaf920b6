"""Portable SQL that lays the ledger, price, card and snapshot tables over the test data.

The text runs unchanged on Spark and DuckDB except for two row generators, ``<years>`` and
``<examples>``, which each engine spells in its own way. Facts are plain projections of one source
table, so a scan of the ledger is a scan of the file. No view cuts its source to a range of keys:
where a feed holds part of the rows by nature, an attribute of the row decides. Rows that must find
no partner carry another key (draft invoices, ended sessions) instead of being left out.
"""

from __future__ import annotations

RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

GENERATORS = {
    "spark": {"<years>": "explode(sequence(first_year, last_year))", "<examples>": "explode(sequence(1, 2))"},
    "duckdb": {
        "<years>": "unnest(generate_series(first_year, last_year))",
        "<examples>": "unnest(generate_series(1, 2))",
    },
}

VIEWS = {
    # ---- companies and scopes
    "company_main": """
        select cast(r_regionkey + 1 as int) as id_company,
               lpad(cast(r_regionkey + 1 as string), 2, '0') as comp_scala, '1' as base_curr
        from {region}""",
    "master_comp_scala": """
        select case when id_company <= 3 then '31' else '32' end as comp_master, comp_scala
        from {company_main}""",
    "company_objects_links": """
        select id_company, 1 as id_object, case when id_company <= 3 then 31 else 32 end as id_example
        from {company_main}
        union all
        select id_company, 5 as id_object, case when id_company <= 3 then 1 else 2 end as id_example
        from {company_main}
        union all
        select id_company, 13 as id_object, case when id_company <= 3 then 1 else 2 end as id_example
        from {company_main}""",
    # ---- dimensions
    "vat_codes": "select * from (values (0, 0), (1, 10), (2, 18), (3, 20)) t(vat_code, vat_prc)",
    "currency_list": """
        select * from (values ('1', 810, 'РУБ'), ('2', 840, 'USD'))
            t(currency_code, currency_id, currency_name_rus)""",
    "organizations": """
        select case when c_nationkey < 15 then 31 else 32 end as id_example,
               c_custkey as organization_id, cast(c_custkey as string) as org_code,
               c_name as org_name,
               case when c_custkey % 3 = 0 then (c_custkey % 10) + 1 else c_custkey end
                   as report_org_id,
               case when c_custkey % 11 = 0 then null
                    when c_custkey % 5 = 0 then lpad(cast(c_custkey * 7919 as string), 12, '0')
                    else lpad(cast(c_custkey * 7919 as string), 10, '0') end as inn,
               case when c_custkey % 7 = 0 then null
                    else lpad(cast(c_nationkey as string), 9, '7') end as kpp
        from {customer}""",
    "plan_schetov": """
        select cast(100 + s_suppkey as string) as account_b, s_name as account_name,
               cast((s_suppkey + year_v + id_example) % 4 as int) as vat_code,
               case when s_suppkey % 3 < 2 then 1 else 0 end as tax_acr,
               case when s_suppkey % 5 < 3 then 1 else 0 end as tax_rd,
               case when s_suppkey % 7 < 4 then 1 else 0 end as tax_pay,
               case when s_suppkey % 11 < 5 then 1 else 0 end as tax_rep,
               case when s_suppkey % 23 < 12 then 1 else 0 end as advance,
               case when s_suppkey % 13 < 7 then 1 else 0 end as auto_system,
               case when s_suppkey % 17 < 9 then 1 else 0 end as purch_book,
               case when s_suppkey % 19 < 10 then '1' else '2' end as currency_id,
               cast(year_v as int) as year_v, cast(id_example as int) as id_example
        from (select s.*, <examples> as id_example
              from (select s_suppkey, s_name, <years> as year_v
                    from (select s_suppkey, s_name,
                                 (select min(year(l_shipdate)) from {lineitem}) as first_year,
                                 (select max(year(l_shipdate)) from {lineitem}) as last_year
                          from {supplier}) r) s) x""",
    "wo_accounts_map": """
        select account_b, 0 as wo_type, '8' || account_b as wo_account, year_v, id_example
        from {plan_schetov} where advance = 1
        union all
        select account_b, 1 as wo_type, '9' || account_b as wo_account, year_v, id_example
        from {plan_schetov} where advance = 1 and tax_rd = 1""",
    "exch_rates": """
        select distinct cast(l_shipdate as date) as rate_date, '2' as src_curr, '1' as trg_curr,
               cast(25 + day(l_shipdate) % 7 as decimal(9,4)) as rate
        from {lineitem}
        union all
        select distinct cast(l_shipdate as date) as rate_date, '1' as src_curr, '1' as trg_curr,
               cast(1 as decimal(9,4)) as rate
        from {lineitem}""",
    # ---- invoices
    "invoices": """
        select o_orderkey as invoice_id,
               case when o_orderpriority = '5-LOW' then 'D' else '' end
                   || cast(o_orderkey as string) as invoice_number,
               'F' || cast(o_orderkey as string) as factura_number,
               cast(o_orderdate as date) as book_date,
               case when o_orderstatus = 'P' then null else cast(o_orderdate as date) end
                   as invoice_date,
               cast(1 + o_orderkey % 5 as int) as id_company, o_custkey as organization_id,
               cast(substring(o_orderpriority, 1, 1) as int) as percent_value,
               'T' || cast(o_orderkey as string) as trans_number,
               case when o_orderstatus = 'P' then cast(o_orderkey + 1 as string) else null end
                   as invoice_no_cred,
               case when o_orderstatus = 'P' then cast(1 + (o_orderkey + 1) % 5 as int)
                    else null end as filial_no_cred
        from {orders}""",
    "invoices_transactions": """
        select l_orderkey as invoice_id, cast(100 + l_suppkey as string) as account_b,
               cast(l_extendedprice as decimal(19,4)) as amount_b
        from {lineitem}""",
    # ---- the movement ledger of one pass (book A)
    "operations": """
        select lpad(cast(1 + l_orderkey % 5 as string), 2, '0') as comp_scala,
               cast(l_partkey as string) as customer_code, cast(l_orderkey as string) as invoice,
               cast(l_shipdate as date) as book_date,
               cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as trans_number,
               cast(100 + l_suppkey as string) as account,
               case when l_linestatus = 'F' then l_linenumber else null end as pay_line,
               cast(case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end
                    as decimal(19,4)) as amount_org,
               cast(1 + l_tax as decimal(9,4)) as pay_rate,
               cast(cast(case when l_returnflag = 'R' then -l_extendedprice
                              else l_extendedprice end as decimal(19,4))
                    + cast(l_linenumber % 3 - 1 as decimal(5,2)) as decimal(19,4)) as amount_loc
        from {lineitem}""",
    # ---- the consolidated ledger (book B): the same movements, some payments booked twice with
    # opposite signs, so that collapsing advances exist
    "operations_lib": """
        select comp_scala, customer_code, invoice, book_date, trans_number, account, '2' as curr,
               amount_loc, amount_org, pay_line, pay_rate,
               cast(month(book_date) as int) as mnth, cast(year(book_date) as int) as year_v,
               's' as s, pay_rate as hist_rate,
               cast(case when amount_org < 0 then amount_loc - round(amount_org * pay_rate, 2)
                         else round(amount_org * pay_rate, 2) - amount_loc end
                    * (case when pay_line % 2 = 0 then 1 else -1 end) as decimal(19,4)) as calc_rd,
               cast(amount_loc - amount_org as decimal(19,4)) as trans_rd,
               cast(book_date - 10 as date) as inv_book_date
        from (
            select * from {operations}
            union all
            select lpad(cast(1 + l_orderkey % 5 as string), 2, '0') as comp_scala,
                   cast(l_partkey as string) as customer_code,
                   cast(l_orderkey as string) as invoice, cast(l_shipdate as date) as book_date,
                   cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || 'M'
                       as trans_number,
                   cast(100 + l_suppkey as string) as account, l_linenumber as pay_line,
                   cast(-l_extendedprice as decimal(19,4)) as amount_org,
                   cast(1 + l_tax as decimal(9,4)) as pay_rate,
                   cast(-l_extendedprice as decimal(19,4)) as amount_loc
            from {lineitem}
            where l_linestatus = 'F' and l_returnflag = 'A' and l_quantity > 30) m""",
    "inv_lib": """
        select comp_scala, invoice, min(account) as account, min(customer_code) as customer_code,
               case when min(pay_line) is null then '1' else '2' end as curr,
               min(book_date) as inv_book_date
        from {operations} group by comp_scala, invoice""",
    # ---- feeds
    "writeoff_list": """
        select lpad(cast(1 + l_orderkey % 5 as string), 2, '0') as comp_scala,
               cast(l_orderkey as string) as invoice_number, cast(l_shipdate as date) as trans_date,
               cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as trans_number,
               cast(l_linenumber % 2 as int) as wo_type
        from {lineitem} where l_quantity >= 38""",
    "reversals": """
        select lpad(cast(1 + l_orderkey % 5 as string), 2, '0') as comp_scala,
               cast(l_orderkey as string) as invoice, cast(l_partkey as string) as org_code,
               cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as trans_number,
               cast(l_shipdate as date) as rev_date,
               cast(l_extendedprice * 2 as decimal(19,4)) as amount_loc,
               cast(l_extendedprice as decimal(19,4)) as amount_org
        from {lineitem} where l_linestatus = 'F' and l_quantity <= 8""",
    "special_trans": """
        select lpad(cast(1 + l_orderkey % 5 as string), 2, '0') as comp_scala,
               cast(year(l_shipdate) as int) as year_v,
               cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as trans_number
        from {lineitem} where l_returnflag = 'N' and l_quantity between 20 and 29""",
    "billing_moving": """
        select lpad(cast(1 + o_orderkey % 5 as string), 2, '0') as comp_scala,
               cast(o_orderkey as string) as invoice
        from {orders} where o_orderpriority = '2-HIGH' and o_orderstatus = 'O'""",
    # ---- prices and cards
    "ch_price": """
        select event_id as id, cast(user_id as string) as kodtov,
               cast(value as decimal(10,2)) as cena, ts as data
        from {events}""",
    "k_kodtov": """
        select distinct cast(user_id as string) as kodtov from {events}
        union all select 'NOPRICE' as kodtov""",
    "card_edges": """
        select o_orderkey as old_card,
               case when o_orderstatus = 'O' then cast(-1 as bigint)
                    when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then o_orderkey
                    when o_orderstatus = 'P' then o_orderkey + 1 - 2 * (o_orderkey % 2)
                    else o_orderkey + 1 + o_custkey % 7 end as new_card,
               cast(o_orderdate as date) as dt
        from {orders}""",
    # ---- activity
    "sessions": """
        select case when c_mktsegment = 'MACHINERY' then -c_custkey else c_custkey end as pid,
               c_mktsegment as datname, c_name as usename,
               'app' || cast(c_nationkey as string) as application_name,
               case when c_acctbal < 0 then 'idle' else 'active' end as state,
               c_name || ' query' as query
        from {customer}""",
    "proc_metrics": """
        select user_id as pid, value as res_mb, value * 2 as virt_mb, value / 2 as swap_mb,
               event_type as command, 'S' as state, event_id as utime, event_id + 1 as stime,
               value as cpu_usage, event_id * 512 as read_bytes, event_id * 64 as write_bytes,
               event_id % 100 as voluntary_ctxt_switches,
               event_id % 10 as nonvoluntary_ctxt_switches,
               cast(1 + event_id % 8 as int) as threads
        from {events}""",
    "history": """
        select ts, user_id as pid, 'db' as datname, event_type as usename, 'app' as application_name,
               'active' as state_q, props as query, value as res_mb, value * 2 as virt_mb,
               value / 2 as swap_mb, event_type as command, 'S' as state, event_id as utime,
               event_id + 1 as stime, value as pcpu, event_id * 512 as read_bytes,
               event_id * 64 as write_bytes, event_id % 100 as voluntary_ctxt_switches,
               event_id % 10 as nonvoluntary_ctxt_switches, cast(1 + event_id % 8 as int) as threads
        from {events}""",
}


def view_text(name: str, engine: str) -> str:
    """SQL of one view with the row generators of the engine filled in."""
    text = VIEWS[name]
    for mark, spelled in GENERATORS[engine].items():
        text = text.replace(mark, spelled)
    return text
