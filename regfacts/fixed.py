"""Names, patterns and formats that results depend on.

Everything here is data given by the disclosure files and reports themselves,
so it must be spelled exactly like this. No logic lives in this module.
"""

# --- bronze files -----------------------------------------------------------
BRONZE_COLUMNS = (
    "Entity", "Country", "Module", "Cell", "Row", "RowName", "Column", "ColumnName", "FactValue",
)
BRONZE_WIDE_COLUMNS = (
    "Entity", "Country", "Module", "Cell", "OpenKey", "Template", "Row", "RowName",
    "Column", "ColumnName", "Sheet", "ReferenceDate", "FactValue",
)
POINTS_SUFFIX = "_data_points.csv"
# texts that the usual CSV readers of data frames take as missing
NA_TOKENS = (
    "", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --- column maps into the canonical schema ----------------------------------
EXPORT_MAP = {
    "Entity Name": "entity_name", "Country": "country", "Module Name": "module_name",
    "Cell": "cell", "Open Key": "open_key", "Template": "template", "Row": "row",
    "Row Name": "row_name", "Column": "column", "Column Name": "column_name", "Sheet": "sheet",
}
LEGACY_MAP = {
    "Entity": "entity_name", "Country": "country", "Module": "module_name", "Cell": "cell",
    "Row": "row", "RowName": "row_name", "Column": "column", "ColumnName": "column_name",
    "FactValue": "fact_value",
}
LEI_MAP = {
    "Entity": "lei", "Country": "entity_name", "Module": "country", "Cell": "module_name",
    "Row": "row", "RowName": "row_name", "Column": "column", "ColumnName": "column_name",
    "FactValue": "fact_value",
}

# --- code and cell patterns -------------------------------------------------
LEI_PATTERN = r"^[A-Z0-9]{20}$"
CELL_TEMPLATE_PATTERN = r"\{\s*(K_[0-9]{2}\.[0-9]{2}(?:\.[a-z0-9]+)?)\s*,"
CELL_TEMPLATE_PATTERN_WIDE = r"\{\s*(K_[0-9]{2,3}\.[0-9]{2}(?:\.[a-z0-9]+)?)\s*,"
CELL_ROW_PATTERN = r",\s*r(\d{4})\s*,"
CELL_COLUMN_PATTERN = r",\s*c(\d{4})\s*\}"
FILE_TEMPLATE_PATTERN = r"^(K_\d{2}\.\d{2})_data_points"
FILE_TEMPLATE_PATTERN_WIDE = r"^(K_\d{2,3}\.\d{2})_data_points"
LABEL_TEMPLATE_PATTERN = r"^(K_\d{2}\.\d{2})\s*-"
OPEN_ROW_PREFIX = "OPEN_"
KEY_NULL_TOKEN = "<NA>"
BROKEN_TEMPLATES = ("K_83.01",)
VIEW_PREFIX = "v_p3dh_"
RUN_PREFIX = "p3dh_"

# --- layout workbooks -------------------------------------------------------
# file name fragment -> module name, tried in this order
MODULES = {
    "CODISPILLAR3": "Common disclosures",
    "FINDISPILLAR3": "Financial disclosures",
    "ESGDISPILLAR3": "ESG disclosures",
    "IRRBBDISPILLAR3": "IRRBB disclosures",
    "MRELTLACDISPILLAR3": "MREL/TLAC disclosures",
    "REMDISPILLAR3": "Remuneration disclosures",
    "GSIIDISPILLAR3": "GSII disclosures",
}
CELL_BREAK = "_x000D_"
CONTENTS_SHEET = "TOC"
SHEET_FILE_PREFIX = "trex_metadata_"
INSTITUTIONS_SHEET = "List of Institutions"

# --- JSON query responses ---------------------------------------------------
# group index -> value dictionary of the standard response shape
GROUP_DICTIONARIES = {1: "D0", 2: "D1", 3: "D2", 5: "D5", 6: "D6", 7: "D7", 8: "D8"}
# group index -> bronze column of the standard response shape
GROUP_COLUMNS = {
    0: "Entity", 1: "Country", 2: "Module", 3: "Cell", 5: "Row", 6: "RowName", 7: "Column",
    8: "ColumnName",
}
# response column name (lower case, underscores as spaces) -> bronze column
RESPONSE_FIELDS = {
    "entity name": "Entity", "ent nam": "Entity", "country": "Country", "module name": "Module",
    "cell": "Cell", "cellcode": "Cell", "open key": "OpenKey", "keydescriptor": "OpenKey",
    "template": "Template", "row": "Row", "row name": "RowName", "row label": "RowName",
    "column": "Column", "column name": "ColumnName", "column label": "ColumnName",
    "sheet": "Sheet", "headerlabel": "Sheet", "referencedate": "ReferenceDate",
    "reference date": "ReferenceDate",
}
ROW_CAP = 5000
TRUNCATION_ROWS = 490

# --- expected downloads -----------------------------------------------------
PERIODS = ("20251231", "20250630")
# category -> (prefix, file pattern, priority)
CATEGORIES = {
    "common_disclosures": ("Common Disclosures", "{period}_common_disclosures.xlsx", 1),
    "financial_disclosures": ("Financial Disclosures", "{period}_financial_disclosures.xlsx", 2),
    "irrbb_disclosures": ("IRRBB", "{period}_irrbb_disclosures.xlsx", 3),
    "mrel_disclosures": ("MREL", "{period}_mrel_disclosures.xlsx", 4),
    "esg_disclosures": ("ESG", "{period}_esg_disclosures.xlsx", 5),
    "renumeration_disclosures": ("Renumeration", "{period}_renumeration_disclosures.xlsx", 6),
}
EXPOSURE_FILES = {
    "tr_oth": "tr_oth.csv", "tr_cre": "tr_cre.csv", "tr_sov": "tr_sov.csv", "tr_mrk": "tr_mrk.csv",
}
