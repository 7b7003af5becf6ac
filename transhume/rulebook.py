"""Fixed values of the migration, kept apart from the operators that use them.

Server and mailbox names differ between installations and are arguments of the
exports; nothing here names one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Role identifiers of the target system.
USER_ROLE_ID = "7d240ffe-f3f3-4015-9aa7-18a3acc854f7"
ADMIN_ROLE_ID = "4498cf39-7fe2-4059-9571-6e65632eb283"

# Roles whose permissions are carried over.
KEPT_ROLE_IDS = (
    "4498cf39-7fe2-4059-9571-6e65632eb283",
    "6385517c-60e2-4866-873d-7859a28c2de3",
    "f00e01b9-ffaa-49c6-b680-7348ef7797a4",
)

# Login prefix of accounts that belong to another platform.
FOREIGN_LOGIN_PREFIX = "D#"

# Group-name marks of each phase, tested in this order.
PHASE_MARKS = (
    (("1-A", "1-B"), 1),
    (("2-A", "2-B"), 2),
    (("3-A", "3-B"), 3),
)

# Programme codes whose 1-A and 1-B groups are funded.
FUNDED_PROGRAMMES = ("FTF", "COF", "SSF", "SAF", "DSF", "DAF", "TSF", "TAF")

# Account type and stage names by source code.
ACCOUNT_TYPES = {0: "standard", 1: "aggressive"}
ACCOUNT_STAGES = {0: "trial", 1: "single", 2: "double", 3: "triple", 4: "instant"}
DEFAULT_ACCOUNT_TYPE = "standard"
DEFAULT_ACCOUNT_STAGE = "trial"

# Codes that change their meaning.
EVENT_CHANGES = {"hardBreach": "hardBreached"}
PAYOUT_STATUS_CHANGES = {3: 4}


@dataclass(frozen=True)
class AccountRules:
    """Names that the account rules depend on, all built from one group path."""

    group_path: str
    funded_groups: tuple[str, ...] = field(default=())

    def _group(self, code: str) -> str:
        return f"{self.group_path}\\U-{code}"

    @property
    def funded(self) -> tuple[str, ...]:
        if self.funded_groups:
            return self.funded_groups
        return tuple(self._group(f"{p}-1-{side}") for p in FUNDED_PROGRAMMES for side in ("A", "B"))

    @property
    def competition_target(self) -> str:
        return self._group("COM-1-B")

    @property
    def funded_target(self) -> str:
        return self._group("FND-1-B")

    @property
    def evaluation_target(self) -> str:
        return self._group("EVL-1-B")
