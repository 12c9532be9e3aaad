"""The sample star schema seen as this domain's deliveries, and the registered queries over it."""
