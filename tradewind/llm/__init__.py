"""Training-data operators: filters, fingerprints, deduplication, packing and scans over documents and pages."""
