"""Names, patterns and code lists that published panels rely on."""

from __future__ import annotations

# Column names of the default long layout.
ENTITY_NAME = "Country Name"
ENTITY_CODE = "Country Code"
SERIES_NAME = "Series Name"
SERIES_CODE = "Series Code"
PERIOD = "Year"
VALUE = "Value"
TOPIC = "Topic"

# Fixed value: what the text of a period must look like.
PERIOD_PATTERN = r"^\d{4}$"

# Columns of the series dimension file, in published order.
DIMENSION_KEY = "id"
DIMENSION_TOPIC = "topic"
DIMENSION_COLUMNS = (
    "id",
    "name",
    "source_id",
    "source",
    "source_organization",
    "topic",
)

# Entity codes that stand for regions, income groups and other
# aggregates instead of a single country or territory.
AGGREGATE_ENTITY_CODES = (
    "AFE", "AFW", "ARB", "CEB", "CSS", "EAP", "EAR", "EAS", "ECA", "ECS",
    "EMU", "EUU", "FCS", "HIC", "HPC", "IBD", "IBT", "IDA", "IDB", "IDX",
    "INX", "LAC", "LCN", "LDC", "LIC", "LMC", "LMY", "LTE", "MEA", "MIC",
    "MNA", "NAC", "OED", "OSS", "PRE", "PSS", "PST", "SAS", "SSA", "SSF",
    "SST", "TEA", "TEC", "TLA", "TMN", "TSA", "TSS", "UMC", "WLD",
)
