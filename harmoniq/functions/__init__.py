"""Column -> Column functions (JVM-side expressions only)."""

from harmoniq.functions.codes import (country_of, label_by_rules, level_of, month_window,
                                      parent_of, period_code_year, quarter_code,
                                      release_from_name, rolling_12m, year_end, year_of,
                                      year_start)
from harmoniq.functions.ids import (content_hash, fatal_text, hard_key, incident_id,
                                    py_text, uuid5)
from harmoniq.functions.metrics import bbox_centre, rate_per_100k, share_pct, step_bucket
from harmoniq.functions.text import (blank_to_null, clean_header, collapse_ws, decimal_comma,
                                     digits_only_long, drop_note_tag, first_non_empty,
                                     fold_key, lenient_long, strip_accents, strip_html)
from harmoniq.functions.urls import (POLICE_PR_OUTLETS, confidence, distinct_domains,
                                     is_listed_outlet, keyword_pattern, lang_key, url_domain)

__all__ = [n for n in dir() if not n.startswith("_")]
