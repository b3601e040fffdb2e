"""All queries of the subpackage."""

from siltwork.llm import (  # noqa: F401
    conversations_query,
    language_model_query,
    language_query,
    licenses_query,
    lines_query,
    mixing_query,
    near_duplicates_query,
    neighbours_query,
    packing_query,
    personal_data_query,
    phrases_query,
    quality_query,
    toxicity_query,
)
from siltwork.llm.registry import RUN, SQL  # noqa: F401
