"""Raw table registry, bronze loading and the test-data binding."""
