"""Reading and writing: file collections, tables, answer keys, copies."""
