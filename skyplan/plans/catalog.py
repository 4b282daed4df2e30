"""Imports every module that registers queries."""

from . import auctionqueries, designqueries, filequeries, morequeries, planning, programqueries, skyqueries, timequeries  # noqa: F401
