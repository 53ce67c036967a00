"""The queries of ``__spark_entry__`` and their SQL twins."""

from wardflow.registry import models, profiles, relational, text
from wardflow.registry.query import Query

ALL: dict[str, Query] = {
    q.name: q for q in relational.QUERIES + text.QUERIES + profiles.QUERIES + models.QUERIES
}
