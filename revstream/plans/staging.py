"""Staging: one rename-and-cast projection per CRM object, deleted records left out.

Each spec line reads ``staged_name=raw_name`` (or just the name when both agree). Types come from
the object's catalog entry unless listed in ``KINDS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from revstream.catalog import CrmObject, crm_object
from revstream.operators.incremental import deleted_column, exclude_deleted

# Staged column names.
SPECS: dict[str, str] = {
    "Account": """
        account_id=id account_name=name account_type=type industry rating account_source=accountsource
        description website annual_revenue=annualrevenue number_of_employees=numberofemployees
        billing_street=billingstreet billing_city=billingcity billing_state=billingstate
        billing_postal_code=billingpostalcode billing_country=billingcountry
        billing_latitude=billinglatitude billing_longitude=billinglongitude parent_id=parentid
        master_record_id=masterrecordid owner_id=ownerid phone fax is_deleted=isdeleted
        created_at=createddate last_modified_at=lastmodifieddate updated_at=systemmodstamp""",
    "Contact": """
        contact_id=id first_name=firstname last_name=lastname full_name=name salutation title department
        account_id=accountid reports_to_id=reportstoid owner_id=ownerid email phone
        mobile_phone=mobilephone fax lead_source=leadsource mailing_street=mailingstreet
        mailing_city=mailingcity mailing_state=mailingstate mailing_postal_code=mailingpostalcode
        mailing_country=mailingcountry is_deleted=isdeleted created_at=createddate
        last_modified_at=lastmodifieddate updated_at=systemmodstamp last_activity_date=lastactivitydate""",
    "Lead": """
        lead_id=id first_name=firstname last_name=lastname full_name=name salutation title email phone
        mobile_phone=mobilephone company industry annual_revenue=annualrevenue
        number_of_employees=numberofemployees website status lead_source=leadsource rating street city
        state postal_code=postalcode country is_converted=isconverted converted_date=converteddate
        converted_account_id=convertedaccountid converted_contact_id=convertedcontactid
        converted_opportunity_id=convertedopportunityid owner_id=ownerid is_deleted=isdeleted
        created_at=createddate last_modified_at=lastmodifieddate updated_at=systemmodstamp
        last_activity_date=lastactivitydate""",
    "Opportunity": """
        opportunity_id=id opportunity_name=name opportunity_type=type description next_step=nextstep
        account_id=accountid owner_id=ownerid campaign_id=campaignid stage_name=stagename
        forecast_category=forecastcategory amount expected_revenue=expectedrevenue
        probability_pct=probability total_quantity=totalopportunityquantity close_date=closedate
        fiscal_quarter=fiscalquarter fiscal_year=fiscalyear is_closed=isclosed is_won=iswon is_lost=isclosed
        has_line_items=hasopportunitylineitem lead_source=leadsource is_deleted=isdeleted
        created_at=createddate last_modified_at=lastmodifieddate updated_at=systemmodstamp
        last_activity_date=lastactivitydate""",
    "OpportunityLineItem": """
        opportunity_line_item_id=id opportunity_id=opportunityid product_id=product2id
        pricebook_entry_id=pricebookentryid product_name=name product_code=productcode description quantity
        unit_price=unitprice list_price=listprice total_price=totalprice service_date=servicedate
        sort_order=sortorder is_deleted=isdeleted created_at=createddate updated_at=systemmodstamp""",
    "Campaign": """
        campaign_id=id campaign_name=name campaign_type=type campaign_status=status
        parent_campaign_id=parentid owner_id=ownerid start_date=startdate end_date=enddate
        budgeted_cost=budgetedcost actual_cost=actualcost expected_revenue=expectedrevenue
        expected_response_pct=expectedresponse number_sent=numbersent number_of_leads=numberofleads
        number_of_converted_leads=numberofconvertedleads number_of_contacts=numberofcontacts
        number_of_responses=numberofresponses number_of_opportunities=numberofopportunities
        number_of_won_opportunities=numberofwonopportunities
        amount_all_opportunities=amountallopportunities amount_won_opportunities=amountwonopportunities
        is_active=isactive is_deleted=isdeleted created_at=createddate last_modified_at=lastmodifieddate
        updated_at=systemmodstamp""",
    "CampaignMember": """
        campaign_member_id=id campaign_id=campaignid lead_id=leadid contact_id=contactid member_type=leadid
        person_id=leadid member_status=status has_responded=hasresponded
        first_responded_date=firstrespondeddate is_deleted=isdeleted created_at=createddate
        updated_at=systemmodstamp""",
    "Task": """
        task_id=id subject task_status=status task_priority=priority who_id=whoid what_id=whatid
        owner_id=ownerid activity_date=activitydate description is_high_priority=ishighpriority
        is_deleted=isdeleted created_at=createddate last_modified_at=lastmodifieddate
        updated_at=systemmodstamp""",
    "Event": """
        event_id=id subject who_id=whoid what_id=whatid owner_id=ownerid start_datetime=activitydatetime
        end_datetime=enddatetime duration_minutes=durationinminutes location description
        is_all_day=isalldayevent is_private=isprivate is_deleted=isdeleted created_at=createddate
        last_modified_at=lastmodifieddate updated_at=systemmodstamp""",
    "User": """
        user_id=id first_name=firstname last_name=lastname full_name=name email username alias title
        department division phone mobile_phone=mobilephone manager_id=managerid user_role_id=userroleid
        profile_id=profileid timezone=timezonesidkey locale=localesidkey is_active=isactive
        created_at=createddate last_modified_at=lastmodifieddate updated_at=systemmodstamp
        last_login_at=lastlogindate""",
}

KINDS = {("Opportunity", "total_quantity"): "decimal(38,4)"}

UNIQUE_KEYS = {name: spec.split()[0].split("=")[0] for name, spec in SPECS.items()}


def renames(obj: str) -> list[tuple[str, str]]:
    return [(w.split("=")[0], w.split("=")[-1]) for w in SPECS[obj].split()]


# Staged columns that are more than a rename.
DERIVED = {
    ("Opportunity", "forecast_category"): "upper(forecastcategory)",
    ("Opportunity", "expected_revenue"): (
        "cast(coalesce(expectedrevenue, cast(probability as decimal(5,2)) * cast(amount as decimal(30,2)) / 100)"
        " as decimal(38,2))"
    ),
    ("Opportunity", "is_lost"): "isclosed and not iswon",
    ("CampaignMember", "member_type"): (
        "case when leadid is not null then 'Lead' when contactid is not null then 'Contact' end"
    ),
    ("CampaignMember", "person_id"): "coalesce(leadid, contactid)",
}


def conform(df: DataFrame, obj: str | CrmObject) -> DataFrame:
    """Add the raw columns the input lacks, as NULLs of their declared type."""
    have = {c.lower() for c in df.columns}
    missing = [f"cast(null as {k}) as {c}" for c, k in crm_object(obj).columns.items() if c not in have]
    return df.selectExpr("*", *missing) if missing else df


def project(raw: DataFrame, obj: str) -> DataFrame:
    """The staged columns without the delete filter."""
    kinds = crm_object(obj).columns
    have = {c.lower() for c in raw.columns}
    if any(o == obj for o, _ in DERIVED):
        raw, have = conform(raw, obj), set(kinds)
    out = []
    for name, src in renames(obj):
        kind = KINDS.get((obj, name), kinds[src])
        if (obj, name) in DERIVED:
            expr = DERIVED[obj, name]
        elif src in have and kind == "string":
            expr = src  # identifiers and text keep the type they arrive with
        else:
            expr = f"cast({src if src in have else 'null'} as {kind})"
        out.append(f"{expr} as {name}")
    return raw.selectExpr(*out)


def stage(raw: DataFrame, obj: str, source: str = "landing") -> DataFrame:
    """The staged rows of one object. Users keep deleted rows; other objects drop them."""
    if obj != "User" and deleted_column(source) in {c.lower() for c in raw.columns}:
        raw = exclude_deleted(raw, source)
    return project(raw, obj)
