"""Folders that several test modules read. A module of its own: test folders below this
one have a ``conftest`` too, and ``import conftest`` finds whichever was loaded last."""

SF_SMALL = "/root/testdata/sf0.001"
