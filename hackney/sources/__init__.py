"""Sources: broker records, trip files, landing folders and stored results."""
