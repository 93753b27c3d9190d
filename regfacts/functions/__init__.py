"""Scalar column functions. All are native expressions, no Python UDF."""

from regfacts.functions.codes import (  # noqa: F401
    cell_column, cell_row, cell_template, code_from_parts, module_from_file, normalize_code,
    row_label_template, strip_sheet_variant, synthetic_cell, template_code, template_from_file,
    template_from_name,
)
from regfacts.functions.dates import (  # noqa: F401
    date_to_folder, epoch_ms_to_date, folder_to_iso, ref_date_from_name, ref_date_from_path,
    to_date_coerce,
)
from regfacts.functions.keys import (  # noqa: F401
    BITMAP_BITS, fact_id, is_open_key, is_set, natural_key, packed_id, parse_open_key, plain_id,
)
from regfacts.functions.labels import (  # noqa: F401
    clean_label, clean_section, dpm_id, infer_unit, safe_name, view_name,
)
from regfacts.functions.numbers import (  # noqa: F401
    decimal_suffix, float_text, numeric_value, safe_int, to_number_coerce,
)
from regfacts.functions.responses import (  # noqa: F401
    canonical_field, decode_index, has_restart_token, is_number, response_messages, truthy,
)
from regfacts.functions.text import (  # noqa: F401
    clean_text, drop_na_tokens, is_missing, nonblank, pack_texts, pystrip, to_json_list, unpack_texts,
)
