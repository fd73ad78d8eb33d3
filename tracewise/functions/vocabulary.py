"""Fixed values of the log vocabulary.

FIXED VALUES — these must equal the source pipeline's literals for results to
match: event types, id prefixes, the feature order the model expects.
"""

# Event types, as they appear in the raw log.
LOGIN_TYPES = ("login_failed", "login_succeeded", "login_attempt")
FILE_TYPES = ("file_accessed", "file_written", "file_updated", "file_created", "file_deleted")
SHARE_LINK = "shared_link"
SHARE_ACCESS = "public_share_accessed"
SHARE_TYPES = (SHARE_LINK, SHARE_ACCESS)

# Graph id prefixes.
USER_PREFIX = "user_"
SHARE_PREFIX = "share_obj_"
FOLDER_PREFIX = "root_folder_"

# Entity type kept by every node and edge rule.
NAMED_ENTITY = "name"

# The model's 12 features, in the order the model expects them.
FEATURES = (
    "AvgLoginAttemptsPerDay",
    "AvgFailedAttemptsPerDay",
    "NumTimesWrittenToSysFolderPerDay",
    "NumTimesDeletedSysFolderPerDay",
    "NumTimesAccessedSysFolderPerDay",
    "NumTimesAccessedNormalFolderPerDay",
    "NumTimesDeletedNormFolderPerDay",
    "HasSharedFiles",
    "NumUsersSharingWithPerDay",
    "NumFilesSharedPerDay",
    "NumFailedFileSharesPerDay",
    "NumFailedShareReadAttemptsPerDay",
)

# Web-API access log: positional column names.
API_LOG_COLUMNS = ("ip", "mac", "user_id", "timestamp_raw", "timezone_raw", "api_call", "status", "code")
API_TS_IN = "dd/MMM/yyyy:HH:mm:ss"
API_TS_OUT = "yyyy-MM-dd'T'HH:mm:ss"
