"""Landing files, format readers and the zone folders."""
