"""DuckDB twins of the table operators, snapshots, functions and scopes."""

from __future__ import annotations

from oracle.arithmetic import base_of, local4, rdiv, twice4, units, vat_of
from oracle.book import key

TIME = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
ISO = "cast({} as string)"
MOMENT = "%d.%m.%Y %H:%M:%S"


def priced(rule: str, text: bool) -> str:
    """Current and previous price by ranking days, newest row of each day."""
    date = (lambda c: f"strftime({c}, '{MOMENT}')") if text else TIME.format
    return f"""
        with p as (select *, cast(data as date) as d,
                          row_number() over (partition by kodtov, cast(data as date)
                                             order by data desc, id desc) as n
                   from {{ch_price}} where {rule}),
             r as (select *, row_number() over (partition by kodtov order by d desc) as k
                   from p where n = 1)
        select k.kodtov, cast(a.cena as double) as price, {date('a.data')} as price_date,
               cast(b.cena as double) as previous_price, {date('b.data')} as previous_date
        from {{k_kodtov}} k left join r a on a.kodtov = k.kodtov and a.k = 1
        left join r b on b.kodtov = k.kodtov and b.k = 2"""


def priced_lines(now: str) -> str:
    """Both prices of every line by asking for its own moment; ``now`` is the rule for the present price."""
    newest = "order by p.data desc, p.id desc limit 1"
    return f"""
        with l as (select l_orderkey, l_linenumber, cast(l_suppkey as string) as kodtov,
                          timestamp '2024-01-01' + ((dayofyear(l_shipdate) - 1) * 4 + l_linenumber) * interval 1 hour
                          + cast(l_quantity as int) * interval 1 minute as moment from lineitem),
             asked as (select distinct kodtov, moment from l),
             one as (select q.kodtov, q.moment, a.cena, a.data from asked q left join lateral
                         (select * from {{ch_price}} p where p.kodtov = q.kodtov and {now} {newest}) a on true),
             days as (select distinct kodtov, cast(data as date) as d from one where data is not null),
             two as (select q.kodtov, q.d, b.cena, b.data from days q left join lateral
                         (select * from {{ch_price}} p where p.kodtov = q.kodtov and p.data < q.d {newest}) b on true)
        select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l.kodtov, {TIME.format('l.moment')} as moment,
               cast(a.cena as double) as price, {TIME.format('a.data')} as price_date,
               cast(b.cena as double) as previous_price, {TIME.format('b.data')} as previous_date
        from l left join one a on a.kodtov = l.kodtov and a.moment = l.moment
        left join two b on b.kodtov = a.kodtov and b.d = cast(a.data as date)"""


ORDERS = f"""o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    {TIME.format('o_orderdate')} as o_orderdate, o_orderpriority"""
EVENTS = f"event_id, {TIME.format('ts')} as ts, user_id, event_type, value, props"
FOUR = "comp_scala, account, cast(pay_line as bigint) as pay_line, cast(book_date as string) as book_date"
NEWER = """exists (select 1 from orders n where n.o_custkey = o.o_custkey
    and (n.o_orderdate > o.o_orderdate
         or (n.o_orderdate = o.o_orderdate and n.o_orderkey > o.o_orderkey)))"""
METRICS = """res_mb, virt_mb, swap_mb, command, state, utime, stime, pcpu, read_bytes, write_bytes,
    voluntary_ctxt_switches, nonvoluntary_ctxt_switches, cast(threads as bigint) as threads"""
M = """m.res_mb, m.virt_mb, m.swap_mb, m.command, m.state, m.utime, m.stime, m.cpu_usage as pcpu,
    m.read_bytes, m.write_bytes, m.voluntary_ctxt_switches, m.nonvoluntary_ctxt_switches,
    cast(m.threads as bigint) as threads"""
S = "s.datname, s.usename, s.application_name, s.state as state_q, s.query"
PROCESSES = f"select m.pid, {S}, {M} from {{proc_metrics}} m left join {{sessions}} s on s.pid = m.pid"
HISTORY = f"""{TIME.format('ts')} as ts, pid, datname, usename, application_name, state_q, query,
    {METRICS}"""
NEWEST_LINES = f"""
        select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber,
               l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
               {TIME.format('l_shipdate')} as l_shipdate
        from (select *, row_number() over (partition by l_orderkey, l_linenumber
                  order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc,
                           l_quantity desc, l_discount desc, l_tax desc, l_returnflag desc,
                           l_linestatus desc) as rn from lineitem) x
        where rn = 1"""
LOCAL = local4("org4", "rate4")

QUERIES = {
    "day_balance": """
        select comp_scala, cast(day as string) as day, cast(balance as double) as balance
        from (select d.comp_scala, d.book_date as day,
                     sum(d.moved) over (partition by d.comp_scala order by d.book_date
                                        rows unbounded preceding) as balance
              from (select comp_scala, book_date,
                           sum(case when pay_line is null then amount_org else -amount_org end)
                               as moved
                    from {operations} group by comp_scala, book_date) d) x""",
    "signed_stats": """
        select cast(min(amount_org) as double) as min_amount,
               cast(max(amount_org) as double) as max_amount,
               cast(sum(amount_org) as double) as sum_amount,
               cast(sum(case when amount_org > 0 then amount_org else 0 end) as double)
                   as sum_positive,
               cast(sum(case when amount_org < 0 then amount_org else 0 end) as double)
                   as sum_negative,
               count(distinct amount_org) as distinct_amounts
        from {operations}""",
    "top_groups": """
        select o_custkey, count(o_orderpriority) as n from orders group by o_custkey
        order by n desc, o_custkey limit 3""",
    "low_average_groups": f"""
        select n_name, cast({rdiv('total', 'n')} as double) / 10000 as average
        from (select n_name, sum(cast(round(c_acctbal * 100) as bigint)) * 100 as total,
                     count(*) as n
              from customer join nation on n_nationkey = c_nationkey group by n_name) x
        where total < 4500 * 10000 * n""",
    "latest_per_key": f"""
        select {EVENTS} from (select *, row_number() over (partition by user_id, event_type
                                     order by ts desc, event_id desc) as rn from events) x
        where rn = 1""",
    "superseded_pairs": f"select {ORDERS} from orders o where not {NEWER}",
    "superseded_rows": f"select {ORDERS} from orders o where {NEWER}",
    "exact_duplicates": f"select {FOUR}, count(*) as copies from {{operations}} group by all",
    "distinct_rows": f"select distinct {FOUR} from {{operations}}",
    "bulk_dedup_slices": NEWEST_LINES,
    "bulk_dedup_in_place": NEWEST_LINES,
    "price_before_day": priced("data < timestamp '2024-01-16 00:00:00'", text=False),
    "price_next_day_effective": priced(
        "cast(cast(data as date) + 1 as timestamp) <= timestamp '2024-01-16 00:00:01'", text=True),
    "price_of_lines_effective": priced_lines("p.data < cast(q.moment as date)"),
    "price_of_lines_before": priced_lines("p.data < q.moment"),
    "lookup_policies": """
        select c.c_custkey as pid, coalesce(e.event_type, 'XXXX') as kept, e.event_type,
               o.org_name as single
        from customer c
        left join (select user_id, event_type, row_number() over (partition by user_id
                          order by ts desc, event_id desc) as rn from events) e
          on e.user_id = c.c_custkey and e.rn = 1
        left join {organizations} o on o.organization_id = c.c_custkey""",
    "chain_change_date": """
        select c.old_card as card, cast(case when x.dt is null then 1 else 0 end as bigint) as allowed,
               cast(cast(x.dt + interval 12 month as date) as string) as next_date
        from (select distinct old_card from {card_edges}) c
        left join (select a.old_card, a.dt from {card_edges} a
                   join {card_edges} b on a.new_card = b.old_card
                   join {card_edges} c on b.new_card = c.old_card
                   join {card_edges} d on c.new_card = d.old_card
                   join {card_edges} e on d.new_card = e.old_card) x on x.old_card = c.old_card""",
    "chain_closure": """
        with recursive walk(card, tip, length, seen, ring) as (
            select old_card, new_card, cast(1 as bigint), [old_card], new_card = old_card
            from {card_edges}
            union all
            select w.card, e.new_card, w.length + 1, list_append(w.seen, w.tip),
                   e.new_card = w.tip or list_contains(w.seen, e.new_card)
            from walk w join {card_edges} e on e.old_card = w.tip where not w.ring)
        select card, case when not bool_or(ring) then max(length) end as length,
               case when not bool_or(ring) then arg_max(tip, length) end as last_card,
               cast(bool_or(ring) as bigint) as cyclic
        from walk group by card""",
    "assign_keys": """
        select p_partkey, p_name,
               (select max(s_suppkey) from supplier)
               + row_number() over (order by p_name, p_partkey) as id
        from part""",
    "plan_of_scope": """
        select '31' as master, cast(year_v as bigint) as year_v, account_b as acc, account_name,
               cast(vat_code as bigint) as vat_code, cast(vat as bigint) as vat,
               cast(tax_acr as bigint) as tax_acr, cast(tax_rd as bigint) as tax_rd,
               cast(tax_pay as bigint) as tax_pay, cast(tax_rep as bigint) as tax_rep,
               cast(advance as bigint) as advance, cast(auto_system as bigint) as auto_system,
               cast(purch_book as bigint) as pl, cur, cast(cur_code as bigint) as cur_code
        from {o_chart}
        where id_example in (select a.id_example from {company_objects_links} a
                             join {company_main} b on b.id_company = a.id_company
                             where a.id_object = 5 and b.comp_scala in
                                 (select comp_scala from {master_comp_scala}
                                  where comp_master = '31'))""",
    "writeoff_map": """
        select s.comp_scala, cast(w.year_v as bigint) as year_v, w.account_b as acc,
               cast(w.wo_type as bigint) as wo_type, w.wo_account
        from {wo_accounts_map} w join {o_sets} s on s.writeoff_set = w.id_example""",
    "customers_of_scope": """
        select s.comp_scala, c.org_code, c.report_org_id, c.org_name, c.organization_id, c.inn,
               p.org_code as parent_code, p.org_name as parent_name
        from {organizations} c join {o_sets} s on s.customer_set = c.id_example
        left join {organizations} p on p.id_example = c.id_example
             and p.organization_id = c.report_org_id""",
    "scope_companies": """
        select comp_scala, count(*) as n, 'all' as asked from {operations}
        where comp_scala in (select comp_scala from {master_comp_scala} where comp_master = '31')
        group by comp_scala
        union all
        select comp_scala, count(*) as n, 'one' as asked from {operations}
        where comp_scala = '02' group by comp_scala""",
    "period_reload": """
        select cast(year_v as bigint) as year_v, cast(mnth as bigint) as mnth, comp_scala,
               count(*) as n, cast(sum(amount_org) as double) as amount_org,
               cast(sum(amount_loc) as double) as amount_loc
        from {operations_lib}
        where not (year_v = 1996 and mnth = 12 and comp_scala in ('01', '02') and amount_org <= 0)
        group by year_v, mnth, comp_scala""",
    "period_delete": f"""
        select invoice_id, {ISO.format('book_date')} as book_date,
               {ISO.format('invoice_date')} as invoice_date
        from {{invoices}}
        where not ((month(book_date) = 12 and year(book_date) = 1996)
                   or coalesce(month(invoice_date) = 12 and year(invoice_date) = 1996, false))""",
    "session_metrics": f"""
        select m.pid, {S}, {M} from {{sessions}} s left join {{proc_metrics}} m on m.pid = s.pid
        where s.pid is not null""",
    "process_sessions": PROCESSES,
    "all_processes": f"select m.pid, {M} from {{proc_metrics}} m",
    "snapshot_append": f"""
        select '2024-01-30 12:00:00.000000' as ts, pid, datname, usename, application_name, state_q,
               query, {METRICS}, '2024-01-30' as day from ({PROCESSES}) v
        union all
        select {HISTORY}, case when cast(ts as date) = date '2024-01-30' then '2024-01-30'
                               when cast(ts as date) = date '2024-01-31' then '2024-01-31'
                               else '__default__' end as day
        from {{history}}""",
    "snapshot_history": f"""
        select '2024-01-30 12:00:00.000000' as ts, pid, datname, usename, application_name, state_q,
               query, {METRICS}, '2024-01-30' as day from ({PROCESSES}) v
        union all
        select {HISTORY}, cast(cast(ts as date) as string) as day from {{history}}
        where cast(ts as date) >= date '2024-01-27'""",
    "snapshot_route": f"""
        select {TIME.format('ts')} as ts, pid,
               case when cast(ts as date) in (date '2024-01-15', date '2024-01-16')
                    then cast(cast(ts as date) as string) else '__default__' end as day
        from {{history}}""",
    "snapshot_retention": f"""
        select {HISTORY}, cast(cast(ts as date) as string) as day from {{history}}
        where cast(ts as date) >= date '2024-01-27'""",
    "snapshot_stream": f"""
        select day, count(*) as n, cast(sum(utime) as bigint) as utime,
               {TIME.format('max(ts)')} as last_ts
        from (select *, case when cast(ts as date) in (date '2024-01-15', date '2024-01-16')
                             then cast(cast(ts as date) as string) else '__default__' end as day
              from {{history}}) x
        group by day""",
    "money_functions": f"""
        select comp_scala, account, cast(sum({LOCAL}) as double) / 10000 as local,
               cast(sum({base_of(LOCAL, '18')}) as double) / 100 as base,
               cast(sum({vat_of(LOCAL, '18')}) as double) / 100 as vat,
               cast(sum(case when {LOCAL} * 10000 <> org4 * rate4 then 1 else 0 end) as bigint)
                   as rounded,
               cast(sum(sign(org4)) as bigint) as sign,
               cast(sum(case when sign(org4) = sign(loc4) then 1 else 0 end) as bigint) as agree,
               cast(sum({twice4('org4', 'rate4')}) as double) / 10000 as twice
        from (select comp_scala, account, {units('amount_org')} as org4, {units('pay_rate')} as rate4,
                     {units('amount_loc')} as loc4 from {{operations}}) x
        group by comp_scala, account""",
    "text_date_functions": f"""
        select invoice_number,
               {key('RG_', "' ' || invoice_number || ' '", 'factura_number', 'book_date')} as doc,
               {key('Act', 'invoice_no_cred', "'1'", 'book_date')} as doc_or_null,
               {ISO.format('last_day(book_date)')} as month_end,
               {ISO.format("cast(book_date + interval 12 month as date)")} as next_year,
               {ISO.format('book_date + 1')} as next_day, {ISO.format('book_date - 1')} as day_before,
               {ISO.format('cast(tick as date)')} as midnight, strftime(tick, '%m/%d/%Y') as us,
               strftime(tick, '%d/%m/%Y') as eu, strftime(tick, '{MOMENT}') as moment,
               strftime(book_date, '%Y%m%d') as compact, {ISO.format('book_date')} as named_day,
               cast(null as string) as no_day,
               {TIME.format('cast(book_date as timestamp)')} as day_first,
               coalesce(invoice_no_cred, '-') as cred, left(factura_number, 3) as cut
        from (select *, cast(book_date as timestamp) + percent_value * interval 1 hour
                        + interval 5 minute + interval 7 second as tick from {{invoices}}) x""",
    "filters_and_sets": """
        select comp_scala, account, count(pay_line) as payments,
               cast(sum(amount_org) as double) as "Сумма", max(trans_number) as "last trans"
        from {operations}
        where amount_org >= -50000 and amount_org < 50000 and (pay_line is null or pay_line <> 3)
          and year(book_date) = 1996 and comp_scala <> '05'
          and account in (select account_b from {plan_schetov} where tax_acr = 1 and id_example in
              (select chart_set from {o_sets} where comp_scala in
                  (select comp_scala from {master_comp_scala} where comp_master = '31')))
        group by comp_scala, account""",
    "read_paths": """
        select c_mktsegment, count(*) as customers, cast(sum(n) as bigint) as orders,
               cast(sum(cast(c_acctbal as decimal(19,4))) as double) as balance
        from customer left join (select o_custkey, count(*) as n from orders group by o_custkey) o
          on o_custkey = c_custkey
        group by c_mktsegment""",
    "unique_guard": """
        select cast(id_company as bigint) as id_company, count(*) as n,
               min(invoice_no_cred) as first_credited, max(trans_number) as last_trans
        from {invoices} group by id_company""",
}
