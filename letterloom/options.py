"""Options handed to the operators; nothing here is read from global state."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

# A run of separator characters, or a header-like word, starts an
# inline message. The last alternative has no colon on purpose.
SEPARATOR_PATTERN = r"[-_*=]{4,}"
HEADER_HINT_PATTERN = r"To:|Subject:|From:|Cc:|Bcc?"

# Accepted body lengths in characters, both ends included.
PRE_GATE = (250, 5_000)
FINAL_GATE = (200, 50_000)


@dataclass(frozen=True)
class MailOptions:
    """Switches and parameters of the message plan.

    Switches are read while the plan is built, so a plan carries only the
    branches it uses.
    """

    tag_content: bool = False
    fill_surrogates: bool = False
    hash_addresses: bool = False
    salt: str | None = None
    hash_mode: str = "sha256"
    anchored_subject: bool = False
    number_words: bool = True
    separator_pattern: str = SEPARATOR_PATTERN
    header_hint_pattern: str = HEADER_HINT_PATTERN
    pre_gate: tuple[int, int] = PRE_GATE
    final_gate: tuple[int, int] = FINAL_GATE
    strip_payload: bool = True
    null_rows: bool = False

    def __post_init__(self) -> None:
        if self.hash_mode not in ("sha256", "pbkdf2"):
            raise ValueError(f"unknown hash_mode: {self.hash_mode}")
        if (self.hash_addresses or self.fill_surrogates) and not self.salt:
            raise ValueError("hashing and surrogates need a salt")
        if self.fill_surrogates and not self.tag_content:
            raise ValueError("surrogates replace tags, so tag_content must be on")

    @classmethod
    def from_mapping(cls, env: Mapping[str, str], salt: str | None = None) -> MailOptions:
        """Build the three switches from environment-style strings ("true" is on)."""
        tag = env.get("DO_CONTENT_TAGGING") == "true"
        return cls(
            tag_content=tag,
            fill_surrogates=tag and env.get("DO_FAKER_REPLACEMENT") == "true",
            hash_addresses=env.get("DO_ADDRESS_HASHING") == "true",
            salt=salt,
        )
