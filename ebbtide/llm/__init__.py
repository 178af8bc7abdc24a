"""Training-data operators: licences, quality, personal data, tokens, archives, secrets, duplicates, leaks, fingerprints."""
