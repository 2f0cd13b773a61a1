"""Reading and writing: scans, sinks, the catalog, file manifests, and scratch space."""
