"""Record sources and configuration documents."""
