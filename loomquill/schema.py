"""Schemas of what the stages exchange."""

META_DDL = "struct<source:string,page:int,source_type:string,table_md:boolean,table_json:boolean,table_row:boolean,image_path:string,caption:boolean,chartqa:boolean,ocr:boolean,vision_label:string,split_method:string,h1:string,h2:string,h3:string>"
DOCUMENT_DDL = f"page_content string, metadata {META_DDL}"
STORE_DDL = f"id string, document string, metadata {META_DDL}, embedding array<float>, base string, kind string"
BUNDLE_DDL = f"text_docs array<struct<page_content:string,metadata:{META_DDL}>>, image_text_docs array<struct<page_content:string,metadata:{META_DDL}>>, img_docs array<struct<page_content:string,metadata:{META_DDL}>>, source_dir string"
REQUEST_DDL = "request_id string, requestId string, message string, text string, api array<struct<role:string,content:string>>, metadata map<string,string>"
KINDS = ("text", "images", "image_pixels")
