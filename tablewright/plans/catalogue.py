"""What a data catalogue is told of plans: a type, and an entity with columns for each table. The client is the caller's."""

from __future__ import annotations

from typing import Any, Protocol

from tablewright.plans.config import Table

TABLE_TYPE = "lakehouse_table"
#: Attributes of that type and their types.
ATTRIBUTES = {"layer": "string", "target_schema": "string", "load_mode": "string", "merge_strategy": "string", "natural_key": "string", "config_file": "string", "column_count": "int"}


class Client(Protocol):
    """What registration asks of a catalogue."""

    def get_type(self, name: str) -> dict | None: ...

    def put_types(self, definitions: dict) -> Any: ...

    def put_entities(self, entities: list[dict]) -> dict: ...


def type_definition() -> dict:
    attributes = [{"name": n, "typeName": t, "isOptional": True} for n, t in ATTRIBUTES.items()]
    return {"entityDefs": [{"name": TABLE_TYPE, "superTypes": ["DataSet"], "description": "A table built from a plan", "attributeDefs": attributes}]}


def entity(plan: Table, root: str = "", config_file: str | None = None) -> dict:
    """The plan's table; columns are named below it, temporary ones are left out."""
    name = "/".join(x for x in (root.rstrip("/"), plan.target.replace(".", "/")) if x)
    columns = [
        {"qualifiedName": f"{name}#{c.name}", "name": c.name, "type": c.data_type.to_spark_sql() if c.data_type else "STRING", "isNullable": c.nullable, "description": c.extensions.get("description", "")}
        for c in plan.columns if not c.temporary
    ]
    values = {
        "layer": plan.layer or None, "target_schema": plan.target_schema, "load_mode": plan.policies.load_mode, "merge_strategy": plan.policies.merge_strategy if plan.policies.load_mode == "merge" else None,
        "natural_key": ", ".join(plan.natural_keys), "config_file": config_file, "column_count": len(columns),
    }
    return {"typeName": TABLE_TYPE, "attributes": {"qualifiedName": name, "name": plan.name, "description": plan.description} | values, "relationshipAttributes": {"schema": columns}}


def register(client: Client | None, plans: list[Table], root: str = "", dry_run: bool = False) -> dict[str, Any]:
    """Register the plans' tables, after their type if the catalogue doesn't know it. A dry run only says what would be sent."""
    entities = [entity(p, root) for p in plans]
    if dry_run or not entities:
        return {"entities": entities, "created": 0, "updated": 0}
    assert client is not None
    if not client.get_type(TABLE_TYPE):
        client.put_types(type_definition())
    changed = (client.put_entities(entities) or {}).get("mutatedEntities", {})
    return {"entities": entities, "created": len(changed.get("CREATE", [])), "updated": len(changed.get("UPDATE", []))}
