"""Schemas and fixed values of the data model.

Column names follow the message and item fields, so JSON written by existing
producers can be read without renaming.
"""

# --- fixed values: metadata types, statuses, stages ------------------------
REGISTRY = "document-registry"
LINEAGE = "document-lineage"
OPERATIONS = "pipeline-operations"

IN_PROGRESS = "IN_PROGRESS"
SUCCEEDED = "SUCCEEDED"
FAILED = "FAILED"

STAGE_CLASSIFIER = "DOCUMENT_CLASSIFIER"
STAGE_PROCESSOR = "DOCUMENT_PROCESSOR"
STAGE_SYNC_OCR = "SYNC_PROCESS_TEXTRACT"
STAGE_ASYNC_START = "ASYNC_START_TEXTRACT"
STAGE_ASYNC_OCR = "ASYNC_PROCESS_TEXTRACT"
STAGE_ANNOTATE = "SYNC_PROCESS_COMPREHEND"

# --- fixed values: keys a message must carry, by metadata type --------------
REQUIRED_KEYS = {
    REGISTRY: ["documentId", "bucketName", "documentName", "documentLink", "principalIAMWriter"],
    LINEAGE: ["documentId", "callerId", "targetBucketName", "targetFileName", "s3Event"],
    OPERATIONS: ["documentId", "bucketName", "objectName", "status", "stage"],
}

# --- fixed values: event names, classes, routes, limits ---------------------
EVENT_DELETE = "ObjectRemoved:Delete"
EVENT_PUT = "ObjectCreated:Put"
EVENT_COPY = "ObjectCreated:Copy"
UNKNOWN_DOCUMENT = "UNKNOWN_YET"
DEFAULT_METADATA = {"owner": "CustomerName", "class": "external_public_report"}
ANALYSED_CLASSES = ["internal_research_report", "external_public_report"]
SYNC_EXTENSIONS = [".jpg", ".jpeg", ".png"]
ASYNC_EXTENSIONS = [".pdf"]
OCR_FEATURES = ["TABLES", "FORMS"]
ANALYSIS_API = "StartDocumentAnalysis"
CHUNK_BYTES = 4096
LIST_PAGE = 25

# --- fixed values: paths and messages ----------------------------------------
ANALYSIS_FOLDER = "/ocr-analysis"
JOB_FOLDER = "/textract-output"
ANNOTATION_FILE = "/comprehend-output.json"
FAILED_ANALYSIS = (
    "Textract job for document ID %s; bucketName %s fileName %s; failed during Textract analysis. "
    "Please double check the document quality"
)
FAILED_RESULTS = (
    "Textract job for document ID %s; bucketName %s fileName %s; failed during Textract processing. "
    "Could not read Textract output files under job Name %s"
)
FAILED_START = "Not able to start document analysis for document Id %s; bucket %s with name %s"
FAILED_ANNOTATION = "Could not send text to Comprehend."
INCOMPLETE_OBJECT = "Missing documentId, bucketName or objectName."

# --- schemas ----------------------------------------------------------------
NOTIFICATION = """
  Records ARRAY<STRUCT<
    eventName: STRING, eventSource: STRING, eventTime: STRING,
    userIdentity: STRUCT<principalId: STRING>,
    s3: STRUCT<bucket: STRUCT<name: STRING>,
               object: STRUCT<key: STRING, versionId: STRING>>>>
"""

QUEUE_MESSAGE = "messageId STRING, eventSourceARN STRING, body STRING"

REGISTRY_MESSAGE = """
  documentId STRING, bucketName STRING, documentName STRING, documentLink STRING,
  principalIAMWriter MAP<STRING, STRING>, documentMetadata MAP<STRING, STRING>,
  documentVersion STRING, timestamp STRING
"""

# callerId arrives as a map from ingest and as plain text from later stages.
LINEAGE_MESSAGE = """
  documentId STRING, callerId STRING, targetBucketName STRING, targetFileName STRING,
  s3Event STRING, versionId STRING, sourceBucketName STRING, sourceFileName STRING,
  timestamp STRING
"""

STATUS_MESSAGE = """
  documentId STRING, bucketName STRING, objectName STRING, status STRING, stage STRING,
  initDoc STRING, message STRING, versionId STRING, timestamp STRING
"""

OCR_NOTICE = """
  JobId STRING, JobTag STRING, Status STRING, API STRING,
  DocumentLocation STRUCT<S3Bucket: STRING, S3ObjectName: STRING>
"""

GEOMETRY = """STRUCT<
  BoundingBox: STRUCT<Width: DOUBLE, Height: DOUBLE, Left: DOUBLE, Top: DOUBLE>,
  Polygon: ARRAY<STRUCT<X: DOUBLE, Y: DOUBLE>>>"""

RELATIONSHIPS = "ARRAY<STRUCT<Type: STRING, Ids: ARRAY<STRING>>>"

BLOCK = f"""STRUCT<
  BlockType: STRING, Id: STRING, Text: STRING, Confidence: DOUBLE,
  Geometry: {GEOMETRY}, Relationships: {RELATIONSHIPS},
  EntityTypes: ARRAY<STRING>, SelectionStatus: STRING,
  RowIndex: BIGINT, ColumnIndex: BIGINT, RowSpan: BIGINT, ColumnSpan: BIGINT>"""

OCR_RESPONSE = f"Blocks ARRAY<{BLOCK}>"

BLOCK_FIELDS = [
    "BlockType", "Id", "Text", "Confidence", "Geometry", "Relationships", "EntityTypes",
    "SelectionStatus", "RowIndex", "ColumnIndex", "RowSpan", "ColumnSpan",
]
