"""DataFrame-to-DataFrame models: staging, intermediate, marts, quality, reports."""
