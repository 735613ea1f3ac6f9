"""The ten CRM objects: wire names, stored types and the staged shape of each.

The raw schema of an object is its list of ``Field``; staging is a rename plus a cast per column.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

META = "_extract_timestamp", "_source_object"
# Fixed value: the one field stored under another name than its own.
_STORED_AS = {"CallDurationInSeconds": "callbackdurationinseconds"}
LOAD_META = {
    "_extract_timestamp": "timestamp_ntz",
    "_source_object": "string",
    "_load_timestamp": "timestamp_ntz",
    "_file_name": "string",
    "_file_row_number": "bigint",
}


@dataclass(frozen=True)
class Field:
    wire: str
    kind: str = "string"
    extracted: bool = True

    @property
    def column(self) -> str:
        return _STORED_AS.get(self.wire, self.wire.lower())


@dataclass(frozen=True)
class CrmObject:
    name: str
    fields: tuple[Field, ...]
    clustered: bool = False
    key: str = field(default="id")

    @property
    def folder(self) -> str:
        return self.name.lower()

    @property
    def extract_fields(self) -> list[str]:
        return [f.wire for f in self.fields if f.extracted]

    @property
    def columns(self) -> dict[str, str]:
        return {f.column: f.kind for f in self.fields}

    def wire_schema(self) -> T.StructType:
        """Everything arrives as text; a key absent from a line reads as NULL."""
        names = [f.wire for f in self.fields] + [*META, "_row_ordinal"]
        return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _fields(text: str, **kinds: str) -> tuple[Field, ...]:
    """Names in natural order; ``!`` marks a field the load maps but the extract never selects."""
    out = []
    for name in text.split():
        bare = name.rstrip("!")
        out.append(Field(bare, kinds.get(bare, _COMMON.get(bare, "string")), not name.endswith("!")))
    return tuple(out)


# Stored types of fields that mean the same in every object.
_COMMON = {
    "IsDeleted": "boolean",
    "CreatedDate": "timestamp_ntz",
    "LastModifiedDate": "timestamp_ntz",
    "SystemModstamp": "timestamp_ntz",
    "LastActivityDate": "date",
    "AnnualRevenue": "decimal(38,2)",
    "NumberOfEmployees": "bigint",
    "ExpectedRevenue": "decimal(38,2)",
}

# Field names of the CRM's wire format, per object.
OBJECTS: dict[str, CrmObject] = {
    o.name: o
    for o in (
        CrmObject(
            "Account",
            _fields(
                "Id Name Type Industry Rating AccountSource Description Website Phone Fax AnnualRevenue "
                "NumberOfEmployees BillingStreet BillingCity BillingState BillingPostalCode BillingCountry "
                "BillingLatitude BillingLongitude ParentId MasterRecordId OwnerId IsDeleted CreatedDate "
                "LastModifiedDate SystemModstamp",
                BillingLatitude="double",
                BillingLongitude="double",
            ),
            clustered=True,
        ),
        CrmObject(
            "Contact",
            _fields(
                "Id FirstName LastName Name Salutation Title Department AccountId ReportsToId OwnerId Email "
                "Phone MobilePhone Fax LeadSource MailingStreet MailingCity MailingState MailingPostalCode "
                "MailingCountry IsDeleted CreatedDate LastModifiedDate SystemModstamp LastActivityDate"
            ),
            clustered=True,
        ),
        CrmObject(
            "Lead",
            _fields(
                "Id FirstName LastName Name Salutation Title Email Phone MobilePhone Company Industry "
                "AnnualRevenue NumberOfEmployees Website Status LeadSource Rating Street City State PostalCode "
                "Country IsConverted ConvertedDate ConvertedAccountId ConvertedContactId ConvertedOpportunityId "
                "OwnerId IsDeleted CreatedDate LastModifiedDate SystemModstamp LastActivityDate",
                IsConverted="boolean",
                ConvertedDate="date",
            ),
            clustered=True,
        ),
        CrmObject(
            "Opportunity",
            _fields(
                "Id Name Type Description NextStep AccountId OwnerId CampaignId StageName ForecastCategory "
                "Amount ExpectedRevenue Probability TotalOpportunityQuantity CloseDate FiscalQuarter FiscalYear "
                "IsClosed IsWon HasOpportunityLineItem LeadSource IsDeleted CreatedDate LastModifiedDate "
                "SystemModstamp LastActivityDate",
                Amount="decimal(38,2)",
                Probability="decimal(5,2)",
                TotalOpportunityQuantity="decimal(18,4)",
                CloseDate="date",
                FiscalQuarter="int",
                FiscalYear="int",
                IsClosed="boolean",
                IsWon="boolean",
                HasOpportunityLineItem="boolean",
            ),
            clustered=True,
        ),
        CrmObject(
            "OpportunityLineItem",
            _fields(
                "Id OpportunityId Product2Id PricebookEntryId Name ProductCode Description Quantity UnitPrice "
                "ListPrice TotalPrice Revenue_Type__c! ServiceDate SortOrder IsDeleted CreatedDate SystemModstamp",
                Quantity="decimal(18,4)",
                UnitPrice="decimal(38,2)",
                ListPrice="decimal(38,2)",
                TotalPrice="decimal(38,2)",
                ServiceDate="date",
                SortOrder="int",
            ),
            clustered=True,
        ),
        CrmObject(
            "Campaign",
            _fields(
                "Id Name Type Status ParentId OwnerId StartDate EndDate BudgetedCost ActualCost ExpectedRevenue "
                "ExpectedResponse NumberSent NumberOfLeads NumberOfConvertedLeads NumberOfContacts "
                "NumberOfResponses NumberOfOpportunities NumberOfWonOpportunities AmountAllOpportunities "
                "AmountWonOpportunities IsActive IsDeleted CreatedDate LastModifiedDate SystemModstamp",
                StartDate="date",
                EndDate="date",
                BudgetedCost="decimal(38,2)",
                ActualCost="decimal(38,2)",
                ExpectedResponse="decimal(5,2)",
                NumberSent="bigint",
                NumberOfLeads="bigint",
                NumberOfConvertedLeads="bigint",
                NumberOfContacts="bigint",
                NumberOfResponses="bigint",
                NumberOfOpportunities="bigint",
                NumberOfWonOpportunities="bigint",
                AmountAllOpportunities="decimal(38,2)",
                AmountWonOpportunities="decimal(38,2)",
                IsActive="boolean",
            ),
        ),
        CrmObject(
            "CampaignMember",
            _fields(
                "Id CampaignId LeadId ContactId Status HasResponded FirstRespondedDate IsDeleted CreatedDate "
                "SystemModstamp",
                HasResponded="boolean",
                FirstRespondedDate="date",
            ),
        ),
        CrmObject(
            "Task",
            _fields(
                "Id Subject Type! Status Priority WhoId WhatId OwnerId ActivityDate Description CallType! "
                "CallDurationInSeconds! CallDisposition! IsHighPriority IsDeleted CreatedDate LastModifiedDate "
                "SystemModstamp",
                ActivityDate="date",
                CallDurationInSeconds="bigint",
                IsHighPriority="boolean",
            ),
        ),
        CrmObject(
            "Event",
            _fields(
                "Id Subject Type! WhoId WhatId OwnerId ActivityDateTime EndDateTime DurationInMinutes Location "
                "Description IsAllDayEvent IsPrivate IsDeleted CreatedDate LastModifiedDate SystemModstamp",
                ActivityDateTime="timestamp_ntz",
                EndDateTime="timestamp_ntz",
                DurationInMinutes="int",
                IsAllDayEvent="boolean",
                IsPrivate="boolean",
            ),
        ),
        CrmObject(
            "User",
            _fields(
                "Id FirstName LastName Name Email Username Alias Title Department Division Phone MobilePhone "
                "ManagerId UserRoleId ProfileId TimeZoneSidKey LocaleSidKey IsActive IsDeleted! CreatedDate "
                "LastModifiedDate SystemModstamp LastLoginDate",
                IsActive="boolean",
                LastLoginDate="timestamp_ntz",
            ),
        ),
    )
}


def crm_object(obj: str | CrmObject) -> CrmObject:
    if isinstance(obj, CrmObject):
        return obj
    if obj not in OBJECTS:
        raise ValueError(f"unknown CRM object: {obj}")
    return OBJECTS[obj]


def source_name(obj: str) -> str:
    """``OpportunityLineItem`` as ``opportunity_line_item``."""
    return re.sub(r"(?<!^)(?=[A-Z])", "_", obj).lower()
