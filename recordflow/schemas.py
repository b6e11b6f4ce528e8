"""Record contracts, as Spark types.

The field lists below are fixed values: they have to equal the published table contracts.
"""

from __future__ import annotations

from pyspark.sql import types as T

BATCH_TIMESTAMPS = ["CreatedDate", "LastModifiedDate", "SystemModstamp"]
BATCH_STRINGS = """
Id IsDeleted AccountId RecordTypeId IsPrivate Name Description StageName Amount Probability
ExpectedRevenue TotalOpportunityQuantity CloseDate Type NextStep LeadSource IsClosed IsWon
ForecastCategory ForecastCategoryName CampaignId HasOpportunityLineItem Pricebook2Id OwnerId
CreatedById LastModifiedById LastActivityDate PushCount LastStageChangeDate FiscalQuarter
FiscalYear Fiscal ContactId LastViewedDate LastReferencedDate HasOpenActivity HasOverdueTask
LastAmountChangedHistoryId LastCloseDateChangedHistoryId DeliveryInstallationStatus__c
TrackingNumber__c OrderNumber__c CurrentGenerators__c MainCompetitors__c Opportunity_Source__c
""".split()

EVENT_STRINGS = """
LastCloseDateChangedHistoryId DeliveryInstallationStatus__c MainCompetitors__c AccountId
FiscalYear ForecastCategory LastReferencedDate ContactId Name TotalOpportunityQuantity
LastAmountChangedHistoryId CreatedById OwnerId CampaignId TrackingNumber__c PushCount
FiscalQuarter StageName LastViewedDate OrderNumber__c LastStageChangeDate Type
CurrentGenerators__c LeadSource LastActivityDate Pricebook2Id Id ForecastCategoryName
LastModifiedById NextStep
""".split()
EVENT_BOOLEANS = """
HasOpportunityLineItem IsClosed HasOpenActivity IsWon IsDeleted HasOverdueTask IsPrivate
""".split()
EVENT_INTEGERS = ["ExpectedRevenue", "Amount", "Probability"]
EVENT_TIMESTAMPS = ["LastModifiedDate", "CloseDate", "SystemModstamp", "CreatedDate"]


def _fields(names: list[str], data_type: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, data_type) for name in names]


BATCH_TARGET = T.StructType(
    _fields(BATCH_STRINGS, T.StringType()) + _fields(BATCH_TIMESTAMPS, T.TimestampType())
)

FISCAL = T.StructType(_fields(["Quarter", "Year"], T.StringType()))

CHANGE_HEADER = T.StructType(
    [
        T.StructField("createdDate", T.TimestampType()),
        T.StructField("replayId", T.LongType()),
        T.StructField("type", T.StringType()),
    ]
)

OPPORTUNITY = T.StructType(
    _fields(EVENT_STRINGS, T.StringType())
    + _fields(EVENT_BOOLEANS, T.BooleanType())
    + _fields(EVENT_INTEGERS, T.LongType())
    + _fields(EVENT_TIMESTAMPS, T.TimestampType())
    + [T.StructField("Fiscal", FISCAL)]
)

STREAM_TARGET = T.StructType(
    OPPORTUNITY.fields
    + [T.StructField("event", CHANGE_HEADER), T.StructField("sobject", OPPORTUNITY)]
)

SCORING_RECORD = T.StructType(
    [
        T.StructField("Id", T.StringType()),
        T.StructField("AccountType", T.StringType()),
        T.StructField("Amount", T.LongType()),
        T.StructField("BillingCountry", T.StringType()),
        T.StructField("IsClosed", T.BooleanType()),
        T.StructField("ForecastCategory", T.StringType()),
        T.StructField("Industry", T.StringType()),
        T.StructField("OpportunitySource", T.StringType()),
        T.StructField("OpportunityType", T.StringType()),
        T.StructField("OwnerRole", T.StringType()),
        T.StructField("ProductFamily", T.StringType()),
        T.StructField("Segment", T.StringType()),
        T.StructField("Stage", T.StringType()),
        T.StructField("IsWon", T.BooleanType()),
    ]
)

ANOMALY_TARGET = T.StructType(
    [
        T.StructField("opportunityId", T.StringType(), nullable=False),
        T.StructField("anomalyCluster", T.LongType(), nullable=False),
    ]
)

DEAD_LETTER = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("payloadString", T.StringType()),
        T.StructField("payloadBytes", T.BinaryType()),
        T.StructField(
            "attributes",
            T.ArrayType(
                T.StructType(
                    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
                )
            ),
        ),
        T.StructField("errorMessage", T.StringType()),
        T.StructField("stacktrace", T.StringType()),
    ]
)

EXAMPLE = T.StructType(
    [T.StructField("x", T.ArrayType(T.FloatType())), T.StructField("y", T.FloatType())]
)

# The opportunity report as exported to CSV. Dates and flags stay text: inferring their types
# would change the text that is hashed later.
REPORT = T.StructType(
    [
        T.StructField("Opportunity Name", T.StringType()),
        T.StructField("Billing State/Province", T.StringType()),
        T.StructField("Account Type", T.StringType()),
        T.StructField("Account Owner", T.StringType()),
        T.StructField("Product Name", T.StringType()),
        T.StructField("Amount", T.LongType()),
        T.StructField("#", T.IntegerType()),
        T.StructField("Account Name", T.StringType()),
        T.StructField("Billing Country", T.StringType()),
        T.StructField("Close Date", T.StringType()),
        T.StructField("Closed", T.BooleanType()),
        T.StructField("Created Date", T.StringType()),
        T.StructField("Forecast Category", T.StringType()),
        T.StructField("Industry", T.StringType()),
        T.StructField("Opportunity Owner", T.StringType()),
        T.StructField("Opportunity Source", T.StringType()),
        T.StructField("Opportunity Type", T.StringType()),
        T.StructField("Owner Role", T.StringType()),
        T.StructField("Product Family", T.StringType()),
        T.StructField("Segment", T.StringType()),
        T.StructField("Stage", T.StringType()),
        T.StructField("Won", T.BooleanType()),
    ]
)


def render(schema: T.StructType) -> str:
    """DDL column list for CREATE TABLE."""
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
