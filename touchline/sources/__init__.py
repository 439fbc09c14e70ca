"""Reading landing folders: files, schemas and values that do not fit."""
