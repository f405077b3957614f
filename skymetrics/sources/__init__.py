"""Readers and writers: landed CSV days, JSON responses, dimension tables and
the mapping of the shared test tables onto observations."""
