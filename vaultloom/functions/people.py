"""Generated attributes, seeded by the row's key.

The values depend on nothing but the key, so a re-run, a lost executor or a
different partitioning gives the same names, and unchanged rows stay unchanged.
"""

from __future__ import annotations

from vaultloom.functions.keys import hex_key
from vaultloom.functions.text import literal, title_case

FIRST_NAMES = (
    "Ana", "Bruno", "Carla", "Diego", "Elisa", "Fabio", "Gabriela", "Hugo",
    "Isabel", "Joana", "Karina", "Lucas", "Marina", "Nadia", "Otavio", "Paula",
)
LAST_NAMES = (
    "Almeida", "Barbosa", "Cardoso", "Dias", "Esteves", "Ferreira", "Gomes",
    "Lima", "Martins", "Nunes", "Oliveira", "Pereira", "Ribeiro", "Santos",
    "Teixeira", "Vieira",
)
MAIL_DOMAINS = ("example.com", "example.net", "example.org")
WORDS = (
    "amber", "basket", "cedar", "drum", "ember", "fabric", "garden", "harbor",
    "island", "jacket", "kettle", "lantern", "marble", "needle", "orchid",
    "pillow", "quartz", "ribbon", "saddle", "timber", "umber", "velvet",
    "willow", "yarn",
)
FIRST_BIRTH_DATE = "1940-01-01"
BIRTH_DAYS = 25000


def _draw(key: str, slot: int, n: int) -> str:
    """A number in [0, n) from the slot's 28 bits of the key's digest."""
    return f"cast(conv(substr({hex_key(key)}, {1 + 7 * slot}, 7), 16, 10) as int) % {n}"


def _pick(values: tuple[str, ...], key: str, slot: int) -> str:
    options = ", ".join(literal(v) for v in values)
    return f"element_at(array({options}), {_draw(key, slot, len(values))} + 1)"


def _digits(key: str, slot: int) -> str:
    return f"lpad(cast({_draw(key, slot, 10000)} as string), 4, '0')"


def person_name(key: str) -> str:
    return f"concat_ws(' ', {_pick(FIRST_NAMES, key, 0)}, {_pick(LAST_NAMES, key, 1)})"


def email(key: str) -> str:
    first, last = _pick(FIRST_NAMES, key, 0), _pick(LAST_NAMES, key, 1)
    number, domain = _draw(key, 2, 100000), _pick(MAIL_DOMAINS, key, 3)
    return f"concat(lower({first}), '.', lower({last}), {number}, '@', {domain})"


def phone_number(key: str) -> str:
    area = f"{_draw(key, 1, 89)} + 11"
    return f"concat('+55 (', {area}, ') 9', {_digits(key, 2)}, '-', {_digits(key, 3)})"


def birth_date(key: str) -> str:
    return f"date_add(DATE'{FIRST_BIRTH_DATE}', {_draw(key, 3, BIRTH_DAYS)})"


def product_name(key: str) -> str:
    words = ", ".join(_pick(WORDS, key, slot) for slot in range(3))
    return title_case(f"concat_ws(' ', {words})")
