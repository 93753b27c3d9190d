"""All queries of this subpackage."""

from regfacts.llm import (  # noqa: F401
    conversation_repair,
    decontaminate,
    license_scan,
    ordinal,
    packing,
    pitman_yor,
    quality_rules,
    relative_parse,
    simhash,
    suffix_dedup,
    token_files,
    warc,
    whitening,
)
from regfacts.llm.registry import ORACLES, QUERIES  # noqa: F401
