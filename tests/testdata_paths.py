"""Folders of the given tables that the tests read (a module of its own: two
``conftest`` modules cannot be told apart by import)."""

SF_SMALL = "/root/testdata/sf0.001"
