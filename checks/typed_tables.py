"""The nineteen typed tables, each against a left join with a null test in plain SQL."""

from __future__ import annotations

from checks.feeds import history, history_sql, raw_feeds, raw_sql
from checks.registry import check
from rosterlake.plans.catalog import APPEND, ENTITIES, NEW_ONLY, Entity
from rosterlake.plans.typed_load import build_rows

# DuckDB trims spaces only unless told; the test text holds spaces, tabs and line ends.
BLANKS = "' ' || chr(9) || chr(10) || chr(13)"
# Registered under shorter names than the table carries.
SHORT = {"multiple_data_extension_send_lists": "data_extension_send_lists"}


def clean_sql(x: str) -> str:
    return f"nullif(trim({x}, {BLANKS}), '')"


def typed_sql(x: str, kind: str) -> str:
    if kind == "bigint":
        return f"cast({x} as bigint)"
    if kind == "boolean":
        return f"cast({x} as boolean)"
    if kind == "timestamp_ntz":
        return f"strptime({clean_sql(x)}, '%m/%d/%Y %I:%M:%S %p')"
    return clean_sql(x)


def rows_sql(name: str) -> str:
    entity: Entity = ENTITIES[name]
    columns = ", ".join(f"{typed_sql('n.' + c, t)} as {c}" for c, t in entity.types.items())
    if entity.rule == APPEND:
        return f"select distinct {columns} from ({raw_sql(name)}) n"
    on = " and ".join(
        f"n.{k} = {clean_sql('o.' + k)}" if k in entity.raw_keys
        else f"{typed_sql('n.' + k, entity.types[k])} = o.{k}" for k in entity.keys)
    keep = "o.load_id is null"
    if entity.rule != NEW_ONLY:
        keep += "".join(f" or {typed_sql('n.' + c, entity.types[c])} <> o.{c}" for c in entity.compare)
    return (f"select distinct {columns} from ({raw_sql(name)}) n "
            f"left join ({history_sql(name)}) o on {on} where {keep}")


def typed_table(spark, sf_dir, name):
    return build_rows(ENTITIES[name], raw_feeds(spark, sf_dir, name), history(spark, sf_dir, name))


for _name in ENTITIES:
    check(f"ods_{SHORT.get(_name, _name)}", rows_sql(_name))(
        lambda spark, sf_dir, name=_name: typed_table(spark, sf_dir, name))
