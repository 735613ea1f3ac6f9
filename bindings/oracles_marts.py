"""Checking SQL for the queries in ``queries_marts``."""

from __future__ import annotations

from bindings.sql_base import AS_OF, LABEL, cents, half_up, out, pct, with_ctes

SPECS = {
    "stg_accounts": """account_id account_name account_type industry rating account_source description website
        annual_revenue:m number_of_employees billing_street billing_city billing_state billing_postal_code
        billing_country billing_latitude billing_longitude parent_id master_record_id owner_id phone fax
        is_deleted:b created_at last_modified_at updated_at""",
    "stg_contacts": """contact_id first_name last_name full_name salutation title department account_id
        reports_to_id owner_id email phone mobile_phone fax lead_source mailing_street mailing_city mailing_state
        mailing_postal_code mailing_country is_deleted:b created_at last_modified_at updated_at
        last_activity_date:d""",
    "stg_leads": """lead_id first_name last_name full_name salutation title email phone mobile_phone company
        industry annual_revenue:m number_of_employees website status lead_source rating street city state
        postal_code country is_converted:b converted_date:d converted_account_id converted_contact_id
        converted_opportunity_id owner_id is_deleted:b created_at last_modified_at updated_at
        last_activity_date:d""",
    "stg_opportunities": """opportunity_id opportunity_name opportunity_type description next_step account_id
        owner_id campaign_id stage_name forecast_category amount:m expected_revenue:m probability_pct:m
        total_quantity:m close_date:d fiscal_quarter fiscal_year is_closed:b is_won:b is_lost:b has_line_items:b
        lead_source is_deleted:b created_at last_modified_at updated_at last_activity_date:d""",
    "stg_line_items": """opportunity_line_item_id opportunity_id product_id pricebook_entry_id product_name
        product_code description quantity:m unit_price:m list_price:m total_price:m service_date:d sort_order
        is_deleted:b created_at updated_at""",
    "stg_campaigns": """campaign_id campaign_name campaign_type campaign_status parent_campaign_id owner_id
        start_date:d end_date:d budgeted_cost:m actual_cost:m expected_revenue:m expected_response_pct:m
        number_sent number_of_leads number_of_converted_leads number_of_contacts number_of_responses
        number_of_opportunities number_of_won_opportunities amount_all_opportunities:m
        amount_won_opportunities:m is_active:b is_deleted:b created_at last_modified_at updated_at""",
    "stg_campaign_members": """campaign_member_id campaign_id lead_id contact_id member_type person_id
        member_status has_responded:b first_responded_date:d is_deleted:b created_at updated_at""",
    "stg_tasks": """task_id subject task_status task_priority who_id what_id owner_id activity_date:d description
        is_high_priority:b is_deleted:b created_at last_modified_at updated_at""",
    "stg_events": """event_id subject who_id what_id owner_id start_datetime end_datetime duration_minutes location
        description is_all_day:b is_private:b is_deleted:b created_at last_modified_at updated_at""",
    "stg_users": """user_id first_name last_name full_name email username alias title department division phone
        mobile_phone manager_id user_role_id profile_id timezone locale is_active:b created_at last_modified_at
        updated_at last_login_at""",
    "dim_account": """account_sk account_id parent_account_id parent_account_name account_name account_type
        industry sub_industry rating account_source website phone annual_revenue:m number_of_employees
        employee_segment revenue_segment billing_street billing_city billing_state billing_postal_code
        billing_country billing_latitude billing_longitude owner_id owner_name owner_department
        owner_is_active:b created_at last_modified_at updated_at built_at""",
    "dim_contact": """contact_sk contact_id account_id account_name industry billing_country first_name last_name
        full_name salutation title department email phone mobile_phone linkedin_url lead_source mailing_city
        mailing_state mailing_country has_opted_out_of_email do_not_call owner_id owner_name owner_department
        created_at last_modified_at updated_at last_activity_date:d birth_date built_at""",
    "dim_lead": """lead_sk lead_id full_name first_name last_name email phone title company industry
        annual_revenue:m number_of_employees lead_source status rating lead_score lead_grade city state country
        employee_segment is_converted:b converted_date:d converted_account_id converted_contact_id
        converted_opportunity_id days_to_convert owner_id owner_name owner_department original_campaign_id
        original_campaign_name original_campaign_type original_campaign_channel last_campaign_id
        last_campaign_name last_campaign_status responded_to_last_campaign:b created_at updated_at
        last_activity_date:d built_at""",
    "dim_user": """user_sk user_id first_name last_name full_name email username alias title department division
        phone mobile_phone manager_id manager_name user_role_id profile_id timezone locale is_active:b
        created_at last_login_at updated_at built_at""",
    "dim_campaign": """campaign_sk campaign_id campaign_name campaign_type campaign_status parent_campaign_id
        parent_campaign_name parent_campaign_type owner_id owner_name start_date:d end_date:d
        campaign_duration_days budgeted_cost:m actual_cost:m budget_variance:m expected_revenue:m
        expected_response_pct:m number_sent utm_source utm_medium utm_content channel is_active:b created_at
        updated_at built_at""",
    "fct_sales_pipeline": """pipeline_id opportunity_id account_sk owner_sk campaign_sk close_date_id:d
        created_date_id:d account_id owner_id campaign_id opportunity_name opportunity_type stage_name
        forecast_category lead_source amount:m probability_pct:m weighted_amount:m expected_revenue:m arr mrr tcv
        account_name industry billing_country employee_segment revenue_segment owner_name owner_department
        campaign_name campaign_channel age_days days_to_close is_current_quarter_close:b is_stale:b
        fiscal_quarter fiscal_year fiscal_quarter_label line_item_count products_purchased created_at updated_at
        is_active:b built_at""",
    "fct_bookings": """booking_id opportunity_id account_sk owner_sk campaign_sk booking_date_id:d
        created_date_id:d account_id owner_id campaign_id opportunity_name opportunity_type stage_name lead_source
        primary_competitor reason_won_lost booking_amount:m arr_booked mrr_booked tcv_booked total_quantity:m
        line_item_count arr_line_items services_line_items products_purchased contract_start_date
        contract_end_date contract_term_months account_name industry billing_country billing_state
        account_annual_revenue:m account_employees employee_segment revenue_segment owner_name owner_department
        campaign_name campaign_type campaign_channel days_to_close age_days fiscal_quarter fiscal_year
        fiscal_quarter_label booking_category close_date:d created_at updated_at built_at""",
    "fct_win_rate": """win_rate_id opportunity_id account_sk owner_sk close_date_id:d created_date_id:d account_id
        owner_id campaign_id is_won:b is_lost:b won_count lost_count opportunity_name opportunity_type
        final_stage_name lead_source primary_competitor reason_won_lost amount:m arr deal_size_band account_name
        industry billing_country employee_segment revenue_segment owner_name owner_department days_to_close
        fiscal_quarter fiscal_year fiscal_quarter_label close_date:d created_at updated_at built_at""",
    "fct_campaign_performance": """campaign_performance_id campaign_id campaign_name campaign_type
        campaign_status channel utm_source utm_medium start_date:d end_date:d campaign_duration_days
        budgeted_cost:m actual_cost:m number_sent total_members lead_members contact_members responded_members
        response_rate_pct sf_number_of_leads sf_converted_leads sf_number_of_contacts sf_number_of_responses
        sf_opportunities sf_won_opportunities sf_pipeline_amount:m sf_won_amount:m total_opportunities
        open_opportunities won_opportunities lost_opportunities total_pipeline_amount:m open_pipeline_amount:m
        won_amount:m won_arr first_won_date:d last_won_date:d cost_per_lead cost_per_opportunity pipeline_roi
        revenue_roi created_at updated_at first_member_added_at last_member_added_at built_at""",
    "fct_demand_generation": """demand_gen_id campaign_member_id campaign_id lead_id contact_id person_id
        member_type member_status has_responded:b first_responded_date:d member_created_at email full_name company
        title industry annual_revenue:m number_of_employees lead_source country state owner_id lead_status
        lead_rating lead_score campaign_name campaign_type channel utm_source utm_medium campaign_start_date:d
        campaign_end_date:d campaign_budgeted_cost:m campaign_actual_cost:m is_mql:b is_sql:b is_customer:b
        lead_is_converted:b converted_date:d converted_account_id converted_opportunity_id_attr
        converted_opp_amount:m converted_opp_arr converted_opp_is_won:b converted_opp_close_date:d
        converted_opp_stage days_to_respond days_member_to_opportunity days_member_to_close built_at""",
}

ORACLES = {name: with_ctes(out(name, spec)) for name, spec in SPECS.items()}

ORACLES["line_item_rollup"] = with_ctes(
    "select opportunity_id, line_item_count, cast(line_items_total as double) as line_items_total, "
    "cast(null as double) as arr_line_items, cast(null as double) as services_line_items, products_purchased "
    "from line_rollup"
)
ORACLES["opportunity_enriched"] = with_ctes(
    out(
        "enriched",
        """opportunity_id opportunity_name opportunity_type stage_name forecast_category amount:m
        expected_revenue:m probability_pct:m total_quantity:m arr mrr tcv lead_source primary_competitor
        reason_won_lost is_closed:b is_won:b is_lost:b has_line_items:b close_date:d fiscal_quarter fiscal_year
        created_at updated_at contract_start_date contract_end_date contract_term_months age_days account_id
        account_name industry account_type billing_country billing_state account_annual_revenue:m
        account_employees owner_id owner_name owner_department owner_manager_id campaign_id campaign_name
        campaign_type campaign_channel line_item_count line_items_total:m arr_line_items services_line_items
        products_purchased""",
    )
)
ORACLES["lead_enriched"] = with_ctes(
    out(
        "leads_enriched",
        """lead_id full_name first_name last_name email phone title company industry annual_revenue:m
        number_of_employees lead_source status rating lead_score lead_grade city state country is_converted:b
        converted_date:d converted_account_id converted_contact_id converted_opportunity_id created_at updated_at
        last_activity_date:d days_to_convert owner_id owner_name owner_department original_campaign_id
        original_campaign_name original_campaign_type original_campaign_channel last_campaign_id
        last_campaign_name last_campaign_status responded_to_last_campaign:b""",
    )
)
ORACLES["latest_campaign_touch"] = with_ctes(
    out(
        "last_touch_of_lead",
        "lead_id last_campaign_id last_campaign_status responded_to_last_campaign:b campaign_member_created_at",
    )
)

_NAMES = {
    "day_of_week_name": "dayname(d)",
    "day_of_week_name_short": "left(dayname(d), 3)",
    "month_name": "monthname(d)",
    "month_name_short": "left(monthname(d), 3)",
}
_Q_END = "cast(date_trunc('quarter', d) + interval 3 months - interval 1 day as date)"
_DATE_COLUMNS = {
    "date_id": "cast(d as varchar)",
    "date_day": "cast(d as varchar)",
    "prior_date": "cast(d - 1 as varchar)",
    "next_date": "cast(d + 1 as varchar)",
    "day_of_week": "isodow(d)",
    **_NAMES,
    "day_of_month": "day(d)",
    "day_of_year": "dayofyear(d)",
    "week_of_year": "weekofyear(d)",
    "week_start_date": "cast(cast(date_trunc('week', d) as date) as varchar)",
    "week_end_date": "cast(cast(date_trunc('week', d) as date) + 6 as varchar)",
    "month_of_year": "month(d)",
    "month_start_date": "cast(cast(date_trunc('month', d) as date) as varchar)",
    "month_end_date": "cast(last_day(d) as varchar)",
    "quarter_of_year": "quarter(d)",
    "quarter_start_date": "cast(cast(date_trunc('quarter', d) as date) as varchar)",
    "quarter_end_date": f"cast({_Q_END} as varchar)",
    "year_number": "year(d)",
    "fiscal_month": "month(d)",
    "fiscal_quarter": "quarter(d)",
    "fiscal_year": "year(d)",
    "fiscal_quarter_label": "'FY' || cast(year(d) as varchar) || '-Q' || cast(quarter(d) as varchar)",
    "is_weekend": "cast(isodow(d) in (6, 7) as varchar)",
    "is_month_start": "cast(d = cast(date_trunc('month', d) as date) as varchar)",
    "is_month_end": "cast(d = last_day(d) as varchar)",
    "is_quarter_start": "cast(d = cast(date_trunc('quarter', d) as date) as varchar)",
    "is_quarter_end": f"cast(d = {_Q_END} as varchar)",
    "is_year_start": "cast(d = make_date(year(d), 1, 1) as varchar)",
    "is_year_end": "cast(d = make_date(year(d), 12, 31) as varchar)",
    "days_ago": f"date_diff('day', d, {AS_OF})",
    "weeks_ago": f"date_diff('day', cast(date_trunc('week', d) as date), cast(date_trunc('week', {AS_OF}) as date)) // 7",
    "months_ago": f"(year({AS_OF}) - year(d)) * 12 + month({AS_OF}) - month(d)",
    "years_ago": f"year({AS_OF}) - year(d)",
    "is_past_or_today": f"cast(d <= {AS_OF} as varchar)",
    "is_today": f"cast(d = {AS_OF} as varchar)",
    "is_future": f"cast(d > {AS_OF} as varchar)",
    "deals_created": "coalesce(c.n, 0)",
    "deals_due": "coalesce(e.n, 0)",
}
ORACLES["dim_date"] = with_ctes(
    "select "
    + ", ".join(f"{e} as {n}" for n, e in _DATE_COLUMNS.items())
    + """ from (select cast(g as date) as d from generate_series(date '2020-01-01', date '2030-12-31', interval 1 day) as s(g)) as days
    left join (select cast(created_at as date) as k, count(*) as n from stg_opportunities group by 1) as c on d = c.k
    left join (select close_date as k, count(*) as n from stg_opportunities group by 1) as e on d = e.k"""
)

ORACLES["pipeline_coverage"] = with_ctes(
    f"""select fiscal_quarter_label, cast(coalesce(p_amount, 0) as double) as open_pipeline,
        cast(coalesce(p_weighted, 0) as double) as weighted_pipeline, coalesce(p_n, 0) as open_deals,
        cast(coalesce(b_amount, 0) as double) as bookings, coalesce(b_n, 0) as won_deals, cast(0 as double) as arr_booked,
        coverage_ratio, case when coverage_ratio >= 3 then '✅ Healthy' when coverage_ratio >= 2 then '⚠️  At Risk'
          when coverage_ratio is not null then '🔴 Critical' else '—' end as coverage_health
    from (select fiscal_quarter_label, p_amount, p_weighted, p_n, b_amount, b_n,
            {half_up(cents("p_amount"), cents("b_amount"))} as coverage_ratio
          from (select fiscal_quarter_label, sum(amount) as p_amount, sum(weighted_amount) as p_weighted, count(*) as p_n
                from fct_sales_pipeline group by 1) as p
          full outer join (select fiscal_quarter_label, sum(booking_amount) as b_amount, count(*) as b_n
                from fct_bookings group by 1) as b using (fiscal_quarter_label))"""
)


def _win_rate(*dims: str) -> str:
    d = ", ".join(dims)
    return with_ctes(
        f"""select {d}, cast(won as bigint) as won, closed, {pct("cast(won as bigint)", "closed")} as win_rate_pct
        from (select {d}, sum(won_count) as won, count(*) as closed from fct_win_rate group by {d})"""
    )


ORACLES["win_rate_by"] = _win_rate("owner_name", "deal_size_band")
ORACLES["win_rate_by_segment"] = _win_rate("industry", "employee_segment", "fiscal_quarter_label")
ORACLES["stage_progression"] = with_ctes(
    """select p.stage_name, stage_order, stage_category, case when stage_category is null then null
          else cast(stage_category <> 'Closed' as varchar) end as is_open, deals, cast(amount as double) as amount,
          cast(weighted as double) as weighted_amount, cast(age as bigint) as total_age_days
    from (select stage_name, count(*) as deals, sum(amount) as amount, sum(weighted_amount) as weighted, sum(age_days) as age
          from fct_sales_pipeline group by 1) as p left join stage_seed as s on p.stage_name = s.stage_name"""
)
ORACLES["bookings_attainment"] = with_ctes(
    f"""select fiscal_quarter_label, cast(bookings_target as double) as bookings_target,
        cast(coalesce(booked, 0) as double) as booked,
        {half_up("coalesce(booked, 0) * 10000", "bookings_target * 100")} as attainment_pct,
        {half_up("coalesce(new_logo, 0) * 10000", "new_logo_target * 100")} as new_logo_attainment_pct,
        {half_up("coalesce(expansion, 0) * 10000", "expansion_target * 100")} as expansion_attainment_pct
    from target_seed left join (
      select fiscal_quarter_label, sum(booking_amount) as booked,
             sum(booking_amount) filter (where booking_category = 'New Logo') as new_logo,
             sum(booking_amount) filter (where booking_category = 'Expansion') as expansion
      from fct_bookings group by 1) as b using (fiscal_quarter_label)"""
)

ORACLES["seed_stage_order"] = with_ctes(
    """select stage_name, stage_order, stage_category, cast(stage_category <> 'Closed' as varchar) as is_open,
        cast(stage_name = 'Closed Won' as varchar) as is_closed_won, cast(stage_name = 'Closed Lost' as varchar) as is_closed_lost,
        coalesce(n, 0) as deals
    from stage_seed left join (select stage_name, count(*) as n from stg_opportunities group by 1) as d using (stage_name)"""
)
ORACLES["seed_bookings_targets"] = with_ctes(
    f"""select fiscal_quarter_label, cast(bookings_target as double) as bookings_target, cast(arr_target as double) as arr_target,
        cast(new_logo_target as double) as new_logo_target, cast(expansion_target as double) as expansion_target,
        coalesce(n, 0) as won_deals
    from target_seed left join (select {LABEL} as fiscal_quarter_label, count(*) as n from stg_opportunities where is_won group by 1) as d
      using (fiscal_quarter_label)"""
)


def _single_touch(direction: str) -> str:
    return with_ctes(
        f"""select campaign_id, cast(count(*) as bigint) as touches, count(*) as deals,
            cast(sum(booking_amount) as double) as attributed_amount
        from (select *, row_number() over (partition by opportunity_id
                order by member_created_at {direction}, campaign_member_id {direction}) as rn from touches)
        where rn = 1 group by campaign_id"""
    )


ORACLES["attribution_first"] = _single_touch("asc")
ORACLES["attribution_last"] = _single_touch("desc")
ORACLES["attribution_linear"] = with_ctes(
    """select campaign_id, cast(sum(n) as bigint) as touches, count(*) as deals,
        cast(sum(micros) as double) / 1000000 as attributed_amount
    from (select campaign_id, n, (2 * cast(booking_amount * 100 as hugeint) * 10000 * n + total) // (2 * total) as micros
          from (select *, cast(sum(n) over (partition by opportunity_id) as bigint) as total
                from (select opportunity_id, campaign_id, count(*) as n, max(booking_amount) as booking_amount
                      from touches group by 1, 2)))
    group by campaign_id"""
)


def _mean(col: str) -> str:
    return half_up(f"sum({col}) * 100", f"count({col}) * 100")


ORACLES["funnel_conversion"] = with_ctes(
    f"""select campaign_type, lead_source, owner_id, members, mql, sql, customers,
        {pct("mql", "members")} as mql_rate_pct, {pct("sql", "mql")} as sql_per_mql_pct,
        {pct("customers", "sql")} as customer_per_sql_pct, avg_days_to_respond, avg_days_to_opportunity, avg_days_to_close
    from (select campaign_type, lead_source, owner_id, count(*) as members, count(*) filter (where is_mql) as mql,
            count(*) filter (where is_sql) as sql, count(*) filter (where is_customer) as customers,
            {_mean("days_to_respond")} as avg_days_to_respond,
            {_mean("days_member_to_opportunity")} as avg_days_to_opportunity,
            {_mean("days_member_to_close")} as avg_days_to_close
          from fct_demand_generation group by 1, 2, 3)"""
)
ORACLES["rep_scorecard"] = with_ctes(
    f"""select u.user_id, u.full_name, u.manager_name, u.department, coalesce(p.n, 0) as open_deals,
        cast(coalesce(p.amount, 0) as double) as open_amount, coalesce(b.n, 0) as won_deals,
        cast(coalesce(b.amount, 0) as double) as booked,
        {half_up(cents("b.amount"), "b.n * 100")} as avg_deal, {pct("w.won", "w.n")} as win_rate_pct,
        coalesce(t.n, 0) as tasks, coalesce(e.n, 0) as events,
        {half_up(cents("p.amount"), cents("b.amount"))} as coverage_ratio,
        {half_up("coalesce(b.amount, 0) * 10000", "500000000")} as attainment_pct
    from dim_user u
    left join (select owner_id, count(*) as n, sum(amount) as amount from fct_sales_pipeline group by 1) as p on u.user_id = p.owner_id
    left join (select owner_id, count(*) as n, sum(booking_amount) as amount from fct_bookings group by 1) as b on u.user_id = b.owner_id
    left join (select owner_id, count(*) as n, cast(sum(won_count) as bigint) as won from fct_win_rate group by 1) as w on u.user_id = w.owner_id
    left join (select owner_id, count(*) as n from stg_tasks group by 1) as t on u.user_id = t.owner_id
    left join (select owner_id, count(*) as n from stg_events group by 1) as e on u.user_id = e.owner_id"""
)


def _recent(col: str) -> str:
    d = f"cast({col} as date)"
    return f"count(*) filter (where date_diff('day', {d}, {AS_OF}) <= 200 and {d} <= {AS_OF})"


ORACLES["account_health"] = with_ctes(
    f"""select a.account_id, a.account_name, a.industry, a.employee_segment, a.revenue_segment, a.owner_name,
        coalesce(p.n, 0) as open_deals, cast(coalesce(p.amount, 0) as double) as open_amount,
        coalesce(b.n, 0) as won_deals, cast(coalesce(b.amount, 0) as double) as booked,
        coalesce(c.n, 0) as contacts, coalesce(t.n, 0) as recent_tasks, coalesce(e.n, 0) as recent_events
    from dim_account a
    left join (select account_id, count(*) as n, sum(amount) as amount from fct_sales_pipeline group by 1) as p on a.account_id = p.account_id
    left join (select account_id, count(*) as n, sum(booking_amount) as amount from fct_bookings group by 1) as b on a.account_id = b.account_id
    left join (select account_id, count(*) as n from stg_contacts group by 1) as c on a.account_id = c.account_id
    left join (select what_id, {_recent("activity_date")} as n from stg_tasks group by 1) as t on a.account_id = t.what_id
    left join (select what_id, {_recent("start_datetime")} as n from stg_events group by 1) as e on a.account_id = e.what_id"""
)


def _gap(table: str, name: str, issue: str, cond: str) -> str:
    return (
        f"select '{name}' as object_name, '{issue}' as issue, count(*) filter (where {cond}) as records, "
        f"count(*) as total from {table}"
    )


ORACLES["crm_data_quality"] = with_ctes(
    " union all ".join(
        [
            _gap("stg_opportunities", "opportunity", "no_close_date", "close_date is null"),
            _gap("stg_opportunities", "opportunity", "no_lead_source", "lead_source is null"),
            _gap("stg_opportunities", "opportunity", "no_closed_flag", "is_closed is null or is_won is null"),
            _gap("stg_opportunities", "opportunity", "negative_amount", "amount < 0"),
            _gap("stg_contacts", "contact", "no_email", "email is null"),
            _gap("stg_contacts", "contact", "no_lead_source", "lead_source is null"),
            _gap("stg_leads", "lead", "no_email", "email is null"),
            _gap("stg_leads", "lead", "no_lead_source", "lead_source is null"),
            _gap("stg_accounts", "account", "no_revenue", "annual_revenue is null"),
            _gap("stg_accounts", "account", "no_employees", "number_of_employees is null"),
        ]
    )
)
ORACLES["pipeline_waterfall"] = with_ctes(
    """select stage_name, count(*) as deals, cast(sum(amount) as double) as amount from opp_history
    where valid_from <= timestamp '2024-03-31 00:00:00' and (valid_to is null or valid_to > timestamp '2024-03-31 00:00:00')
    group by stage_name"""
)
ORACLES["stage_velocity"] = with_ctes(
    """select stage_name, count(*) as versions, cast(sum(n) as bigint) as total_days, max(n) as max_days
    from (select stage_name, date_diff('day', cast(valid_from as date), coalesce(cast(valid_to as date), date '2026-12-31')) as n
          from opp_history) group by stage_name"""
)
ORACLES["stage_regression"] = with_ctes(
    """select opportunity_id, from_stage, to_stage, moved_at from (
        select h.id as opportunity_id, h.stage_name as to_stage, h.valid_from as moved_at, s.stage_order,
               lag(h.stage_name) over w as from_stage, lag(s.stage_order) over w as from_order
        from opp_history h left join stage_seed s on h.stage_name = s.stage_name
        window w as (partition by h.id order by h.valid_from)) where from_order > stage_order"""
)
_WEIGHTED = "cast(amount * probability_pct * cast(0.01 as decimal(3,2)) as decimal(38,2))"
ORACLES["forecast_accuracy"] = with_ctes(
    f"""select cast(q as varchar) as quarter_start, forecast_deals, cast(forecast_amount as double) as forecast_amount,
        won_deals, cast(won_amount as double) as won_amount,
        'FY' || cast(year(q) as varchar) || '-Q' || cast(quarter(q) as varchar) as fiscal_quarter_label,
        {half_up(cents("forecast_amount"), cents("won_amount"))} as accuracy_ratio
    from (select q, count(*) filter (where live) as forecast_deals,
            coalesce(sum({_WEIGHTED}) filter (where live), 0) as forecast_amount,
            count(*) filter (where won) as won_deals, coalesce(sum(amount) filter (where won), 0) as won_amount
          from (select *, is_won and valid_to is null as won,
                  not is_closed and valid_from <= cast(q as timestamp) and (valid_to is null or valid_to > cast(q as timestamp)) as live
                from (select *, cast(date_trunc('quarter', close_date) as date) as q from opp_history))
          group by q)"""
)
