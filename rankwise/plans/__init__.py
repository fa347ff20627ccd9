"""Views over the inputs, the registry of named analyses, their SQL oracle
and the export of all result tables."""
