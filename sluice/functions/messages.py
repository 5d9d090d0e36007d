"""User-facing message texts the manifest carries."""

# Structure probe rejections, in the order they are checked.
EMPTY_FILE = "The uploaded CSV file is completely empty."
NOT_UTF8 = (
    "The file is not valid UTF-8. It was probably exported from an older version "
    "of Excel. Re-save it as 'CSV UTF-8'."
)
NO_DATA_ROWS = "The CSV file has a header row but no data rows."
NO_HEADER = "The CSV file does not contain a header."
NOT_COMMA_SEPARATED = (
    "The file does not appear to be comma-separated. Its whole header was read as a "
    "single column. Re-export it as a standard comma-delimited CSV."
)
BLANK_COLUMN_NAME = "The CSV header contains a blank column name."
