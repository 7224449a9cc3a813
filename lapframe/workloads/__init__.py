"""The library's operators bound to a generic set of test tables, with SQL to compare with."""
