"""Table catalogue: product structure, audit, metrics and file registries."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from dockhand.operators.quality import ForeignKey, NotNull, Positive, Rule, Unique

_PART_COLUMNS = (
    "PartNumber STRING, Nomenclature STRING, ProcurementTypeID BIGINT, Mass DECIMAL(10,2), "
    "UnitID BIGINT, CriticalSafetyItem BOOLEAN, ExportClassification STRING, "
    "Statement_Export STRING, CreatedAt TIMESTAMP_NTZ, CreatedBy STRING"
)

# Names and columns of the tables. Integer keys are BIGINT.
TABLES = {
    "ProcurementTypes": "ProcurementTypeID BIGINT, TypeName STRING",
    "Categories": "CategoryID BIGINT, CategoryName STRING",
    "Units": "UnitID BIGINT, UnitName STRING",
    "Parts": f"PartID BIGINT, {_PART_COLUMNS}",
    "Products": (
        "ProductID BIGINT, ProductName STRING, Description STRING, CategoryID BIGINT, "
        "CreatedAt TIMESTAMP_NTZ, CreatedBy STRING, Configuration STRING"
    ),
    "ProductAttributes": "AttributeID BIGINT, ProductID BIGINT, AttributeName STRING, AttributeValue STRING",
    "BOM": "BOMID BIGINT, ProductID BIGINT, PartID BIGINT, Quantity BIGINT",
    "Status": "StatusID BIGINT, StatusName STRING",
    "PartRevisions": (
        "RevisionID BIGINT, PartID BIGINT, Revision STRING, CreatedAt TIMESTAMP_NTZ, CreatedBy STRING, StatusID BIGINT"
    ),
    "ChangeManagement": (
        "ChangeID BIGINT, PartID BIGINT, ChangeType STRING, StatusID BIGINT, "
        "ChangeDescription STRING, RequestedBy STRING, ChangeDate TIMESTAMP_NTZ"
    ),
    "PartComponents": "ComponentID BIGINT, ParentPartID BIGINT, ChildPartID BIGINT, Quantity BIGINT",
    "Assemblies": "AssemblyID BIGINT, AssemblyName STRING, Description STRING",
    "Occurrences": (
        "OccurrenceID BIGINT, PartID BIGINT, AssemblyID BIGINT, ReferenceDesignator STRING, Quantity BIGINT"
    ),
    "Stakeholders": (
        "StakeholderID BIGINT, FullName STRING, Email STRING, Telephone STRING, "
        "Geography STRING, Language STRING, CreatedAt TIMESTAMP_NTZ"
    ),
    "RevisionEffectivity": "EffectivityID BIGINT, RevisionID BIGINT, UsedOn DATE, EffectiveToDate DATE",
    "PartsAudit": (
        f"AuditID BIGINT, PartID BIGINT, {_PART_COLUMNS}, Action STRING, "
        "ActionTimestamp TIMESTAMP_NTZ, ActionUser STRING"
    ),
    "FileProcessingMetrics": (
        "MetricID BIGINT, ProcessedAt TIMESTAMP_NTZ, TotalProcessed BIGINT, TotalFailed BIGINT, "
        "TotalRetried BIGINT, AvgProcessingTime DECIMAL(10,2)"
    ),
    # Tables the jobs write to without a declaration of their own.
    "FileProcessingMonitor": (
        "FileID BIGINT, Status STRING, ErrorLog STRING, DurationSeconds DOUBLE, "
        "LastRetryAt TIMESTAMP_NTZ, Retries BIGINT, ProcessedAt TIMESTAMP_NTZ"
    ),
    "FileProcessingLogs": "FileID BIGINT, LogMessage STRING, LogLevel STRING",
    "FileHashes": "filename STRING, sha256 STRING, md5 STRING",
    "FileMetadata": "filename STRING, metadata STRING",
}

# The declared constraints.
RULES: list[Rule] = [
    *[
        NotNull(table, column)
        for table, column in [
            ("ProcurementTypes", "TypeName"),
            ("Categories", "CategoryName"),
            ("Units", "UnitName"),
            ("Parts", "PartNumber"),
            ("Parts", "Nomenclature"),
            ("Products", "ProductName"),
            ("ProductAttributes", "AttributeName"),
            ("Status", "StatusName"),
            ("Assemblies", "AssemblyName"),
        ]
    ],
    *[
        Unique(table, column)
        for table, column in [
            ("ProcurementTypes", "TypeName"),
            ("Categories", "CategoryName"),
            ("Units", "UnitName"),
            ("Parts", "PartNumber"),
            ("Status", "StatusName"),
        ]
    ],
    *[
        ForeignKey(table, column, parent, parent_column)
        for table, column, parent, parent_column in [
            ("Parts", "ProcurementTypeID", "ProcurementTypes", "ProcurementTypeID"),
            ("Parts", "UnitID", "Units", "UnitID"),
            ("Products", "CategoryID", "Categories", "CategoryID"),
            ("ProductAttributes", "ProductID", "Products", "ProductID"),
            ("BOM", "ProductID", "Products", "ProductID"),
            ("BOM", "PartID", "Parts", "PartID"),
            ("PartRevisions", "PartID", "Parts", "PartID"),
            ("PartRevisions", "StatusID", "Status", "StatusID"),
            ("ChangeManagement", "PartID", "Parts", "PartID"),
            ("ChangeManagement", "StatusID", "Status", "StatusID"),
            ("PartComponents", "ParentPartID", "Parts", "PartID"),
            ("PartComponents", "ChildPartID", "Parts", "PartID"),
            ("Occurrences", "PartID", "Parts", "PartID"),
            ("Occurrences", "AssemblyID", "Assemblies", "AssemblyID"),
            ("RevisionEffectivity", "RevisionID", "PartRevisions", "RevisionID"),
        ]
    ],
    *[Positive(table, "Quantity") for table in ("BOM", "PartComponents", "Occurrences")],
]

# An enriched document.
DOCUMENT = (
    "file_id BIGINT, path STRING, content STRING, metadata MAP<STRING,STRING>, "
    "extraction_method STRING, content_length BIGINT, word_count BIGINT, language STRING, "
    "entities ARRAY<STRUCT<text: STRING, label: STRING>>, keywords ARRAY<STRING>, "
    "sha256 STRING, processed_at TIMESTAMP_NTZ"
)


def schema(table: str) -> StructType:
    """Spark schema of a catalogue table."""
    return StructType.fromDDL(TABLES[table])


def create_tables(spark: SparkSession, database: str, table_format: str = "parquet") -> None:
    """Create every catalogue table that does not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, columns in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING {table_format}")
