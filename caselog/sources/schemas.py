"""Declared schemas of the landed sources.

A streaming file source needs a fixed schema, and inferring one would cost a full pass over the
files. Fields that are not declared are reported by readers.schema_drift.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def shape(spec) -> DataType:
    """Type of a nested literal: a list is an array, a dict a struct, a tuple a struct of strings."""
    if isinstance(spec, DataType):
        return spec
    if isinstance(spec, list):
        return ArrayType(shape(spec[0]))
    if isinstance(spec, tuple):
        spec = dict.fromkeys(spec, StringType())
    return StructType([StructField(name, shape(inner)) for name, inner in spec.items()])


TEXT = StringType()

# The field names of the four public sources.
REPORTS = shape(
    dict.fromkeys(
        [
            "safetyreportid",
            "safetyreportversion",
            "companynumb",
            "authoritynumb",
            "duplicate",
            "reportduplicate",
            "reporttype",
            "serious",
            "seriousnessdeath",
            "seriousnesshospitalization",
            "seriousnesslifethreatening",
            "seriousnessdisabling",
            "seriousnesscongenitalanomali",
            "seriousnessother",
            "fulfillexpeditecriteria",
            "occurcountry",
            "primarysourcecountry",
        ],
        TEXT,
    )
    | {
        "primarysource": ("reportercountry", "qualification", "literaturereference"),
        "sender": ("senderorganization", "sendertype"),
        "receiver": ("receiverorganization", "receivertype"),
        "receiptdate": TEXT,
        "receivedate": TEXT,
        "transmissiondate": TEXT,
        "receiptdateformat": TEXT,
        "patient": {
            "patientsex": TEXT,
            "patientagegroup": TEXT,
            "patientonsetage": TEXT,
            "patientonsetageunit": TEXT,
            "patientweight": TEXT,
            "summary": ("narrativeincludeclinical",),
            "drug": [
                {
                    "drugcharacterization": TEXT,
                    "medicinalproduct": TEXT,
                    "openfda": {"generic_name": [TEXT]},
                }
            ],
            "reaction": [("reactionmeddrapt", "reactionoutcome")],
        },
        "_pulled_at": TEXT,
    }
)

STUDIES = shape(
    {
        "protocolSection": {
            "identificationModule": {
                "nctId": TEXT,
                "acronym": TEXT,
                "briefTitle": TEXT,
                "officialTitle": TEXT,
                "orgStudyIdInfo": ("id",),
                "organization": ("fullName", "class"),
                "nctIdAliases": [TEXT],
            },
            "sponsorCollaboratorsModule": {
                "leadSponsor": ("name", "class"),
                "collaborators": [("name", "class")],
            },
            "designModule": {
                "studyType": TEXT,
                "phases": [TEXT],
                "enrollmentInfo": {"count": LongType(), "type": TEXT},
                "designInfo": {
                    "allocation": TEXT,
                    "interventionModel": TEXT,
                    "primaryPurpose": TEXT,
                    "maskingInfo": ("masking",),
                },
            },
            "conditionsModule": {"conditions": [TEXT], "keywords": [TEXT]},
            "armsInterventionsModule": {
                "armGroups": [("label", "type")],
                "interventions": [("type", "name")],
            },
            "statusModule": {
                "overallStatus": TEXT,
                "lastKnownStatus": TEXT,
                "whyStopped": TEXT,
                "expandedAccessInfo": {"hasExpandedAccess": BooleanType(), "nctId": TEXT},
                "startDateStruct": ("date", "type"),
                "primaryCompletionDateStruct": ("date", "type"),
                "completionDateStruct": ("date", "type"),
                "studyFirstPostDateStruct": ("date",),
                "lastUpdatePostDateStruct": ("date",),
                "resultsFirstPostDateStruct": ("date",),
            },
        },
        "_pulled_at": TEXT,
    }
)

APPLICATIONS = shape(
    {
        "application_number": TEXT,
        "sponsor_name": TEXT,
        "products": [("product_number", "brand_name")],
        "submissions": [("submission_type", "submission_number")],
        "openfda": {"application_number": [TEXT], "brand_name": [TEXT]},
        "_pulled_at": TEXT,
    }
)

DESCRIPTORS = shape(
    {"descriptor_ui": TEXT, "descriptor_name": TEXT, "tree_numbers": [TEXT], "_pulled_at": TEXT}
)

DESCRIPTOR_XML = shape(
    {"DescriptorUI": TEXT, "DescriptorName": ("String",), "TreeNumberList": {"TreeNumber": [TEXT]}}
)

OUTCOME_CODES = shape(("outcome_code", "outcome_label"))

PARTITION_INDEX = shape({"file": TEXT, "records": LongType(), "size_mb": TEXT})

# The reaction outcome codes.
OUTCOME_ROWS = [
    ("1", "Recovered/resolved"),
    ("2", "Recovering/resolving"),
    ("3", "Not recovered/not resolved"),
    ("4", "Recovered/resolved with sequelae"),
    ("5", "Fatal"),
    ("6", "Unknown"),
]

CORRUPT_COLUMN = "_corrupt_record"


def with_corrupt_column(schema: StructType) -> StructType:
    """The schema plus the column in which the JSON reader keeps lines it cannot parse."""
    if CORRUPT_COLUMN in schema.fieldNames():
        return schema
    return StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType())])
