"""The lattice of roles: a number says how weak a role is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Roles from the strongest, and the role that each type of correspondence gives.
ROLES = ("principal", "parcial", "apoyo")
ROLE_OF_EDGE = {"equivalente": "principal", "parcial": "parcial", "apoyo": "apoyo"}


def weakness(role: Column, roles: tuple[str, ...] = ROLES) -> Column:
    out = F.lit(None).cast("int")
    for k, r in enumerate(roles):
        out = F.when(role == r, k).otherwise(out)
    return out


def role_of(strength: Column, roles: tuple[str, ...] = ROLES) -> Column:
    return F.element_at(F.array(*map(F.lit, roles)), strength.cast("int") + 1)


def edge_role(kind: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in ROLE_OF_EDGE.items() for x in kv])[kind]
