"""``DataFrame -> DataFrame`` steps; chain them with ``DataFrame.transform``."""
