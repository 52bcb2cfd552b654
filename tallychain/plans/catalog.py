"""Imports every module that registers queries."""

from tallychain.plans import (  # noqa: F401
    bank,
    blocks,
    fees,
    layer1,
    layer2,
    layer3,
    reverse,
)
from tallychain.plans import from_files  # noqa: F401  isort: skip
