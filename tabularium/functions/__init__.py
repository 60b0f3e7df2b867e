"""Column expressions. All of them are JVM-side built-ins; there is no Python UDF in this package."""

from tabularium.functions.dates import DATE_FLOOR, floor_date, month_of, parse_date, year_of
from tabularium.functions.html import (
    NO_PHONE,
    SEARCH_PAGE,
    PageLayout,
    extract_links,
    extract_phone,
    extract_results,
    strip_tags,
    unescape_entities,
)
from tabularium.functions.keys import (
    activity_label,
    address_line,
    compose_key,
    pad_key,
    place_line,
    search_key,
    search_name,
)
from tabularium.functions.labels import (
    AGE_BANDS,
    COMPANY_SIZES,
    PARTNER_KINDS,
    REVENUE_BANDS,
    label_code,
)
from tabularium.functions.text import (
    COUNTRY_RULES,
    LEGAL_NATURE_RULES,
    QUALIFICATION_RULES,
    STREET_TYPE_RULES,
    Repair,
    clean_text,
    fold_accents,
    repair_text,
    strip_undecodable,
)
