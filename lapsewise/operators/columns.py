"""Names of the portfolio columns an operator works on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Names:
    contract: str = "contract_id"
    client: str = "client_id"
    start: str = "start"
    end: str = "end"
    network: str = "network"


DEFAULT = Names()
HEALTH = Names("idCtr", "uidpersgen", "date_effet", "date_resil", "libreseaucalcule")
