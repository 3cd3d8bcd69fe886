"""Turn nested commerce exports into clean relational tables on Spark."""

from .operators.entities import prune_columns, split_entities
from .operators.filters import date_window
from .operators.loads import full_load, latest_per_key, upsert
from .operators.reshape import array_child, nested_to_json, object_child, rename_snake
from .plans.normalise import normalise, normalise_fixed
from .plans.run import run_selected
from .session import local_session, tune
from .sinks.outputs import load_all, write_all, write_dataset
from .sources.bulk import scan_bulk
from .sources.pages import flatten_pages
from .streaming.landing import land_stream, read_landed

__all__ = [
    "array_child",
    "date_window",
    "flatten_pages",
    "full_load",
    "land_stream",
    "latest_per_key",
    "load_all",
    "local_session",
    "nested_to_json",
    "normalise",
    "normalise_fixed",
    "object_child",
    "prune_columns",
    "read_landed",
    "rename_snake",
    "run_selected",
    "scan_bulk",
    "split_entities",
    "tune",
    "upsert",
    "write_all",
    "write_dataset",
]
