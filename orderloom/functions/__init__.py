from .dates import date_bound, iso_date, resolve_date
from .gids import entity_type, gid_key, is_entity, make_gid
from .names import clean_name, dataset_name, snake, snake_text
from .values import is_nested, join_list, json_path, json_text, manifest_type, split_list

__all__ = [
    "clean_name",
    "dataset_name",
    "date_bound",
    "entity_type",
    "gid_key",
    "is_entity",
    "is_nested",
    "iso_date",
    "join_list",
    "json_path",
    "json_text",
    "make_gid",
    "manifest_type",
    "resolve_date",
    "snake",
    "snake_text",
    "split_list",
]
