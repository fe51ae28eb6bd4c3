"""What the channel reports have to select, written out as SQL.

The check of the report specs: it names columns, landed paths, labels and filters on its own, so
that a change of a spec shows. ``{path}`` stands for a landed value; the fixture says what it is.
"""

from __future__ import annotations

REPORTS = {
    "google_ad": """
SELECT
  {segments.ad_network_type} AS "networkType",
  {segments.date} AS "segmentsDate",
  {campaign.id} AS "campaignId",
  {campaign.name} AS "campaignName",
  {campaign.advertising_channel_type} AS "campaignAdvertisingChannelType",
  {campaign.advertising_channel_sub_type} AS "campaignAdvertisingChannelSubType",
  {ad_group.id} AS "adgroupId",
  {ad_group.name} AS "adgroupName",
  {ad_group_ad.ad.id} AS "adId",
  {ad_group_ad.ad.name} AS "adName",
  {metrics.impressions} AS "metricsImpressions",
  {metrics.cost_micros} AS "metricsCostMicros",
  {metrics.clicks} AS "metricsClicks",
  {metrics.interactions} AS "metricsInteractions",
  {metrics.ctr} AS "metricsCtr",
  {metrics.view_through_conversions} AS "metricsViewThroughConversions",
  {metrics.conversions} AS "metricsConversions",
  {metrics.conversions_from_interactions_rate} AS "metricsConversionsFromInteractionRate",
  {metrics.cost_per_conversion} AS "metricsCostPerConversions",
  {metrics.all_conversions} AS "metricsAllConversions",
  {metrics.all_conversions_from_interactions_rate} AS "metricsAllConversionsFromInteractionRate",
  {metrics.cost_per_all_conversions} AS "metricsCostPerAllConversions",
  {metrics.video_quartile_p100_rate} AS "metricsVideoQuartileP100Rate",
  {metrics.video_quartile_p25_rate} AS "metricsVideoQuartileP25Rate",
  {metrics.video_quartile_p50_rate} AS "metricsVideoQuartileP50Rate",
  {metrics.video_quartile_p75_rate} AS "metricsVideoQuartileP75Rate",
  {metrics.video_views} AS "metricsVideoViews",
  {metrics.video_view_rate} AS "metricsVideoViewRate"
""",
    "google_keyword": """
SELECT
  {campaign.id} AS "campaignId",
  {campaign.name} AS "campaignName",
  {ad_group.id} AS "adgroupId",
  {ad_group.name} AS "adgroupName",
  {ad_group_criterion.keyword.text} AS "keyword",
  {metrics.cost_micros} AS "costMicros",
  {metrics.clicks} AS "clicks",
  {metrics.impressions} AS "impressions",
  {metrics.conversions} AS "conversions",
  {segments.date} AS "segmentDate",
  {segments.device} AS "segmentDevice"
""",
    "google_search_term": """
SELECT DISTINCT
  {campaign.id} AS "campaignId",
  {campaign.name} AS "campaignName",
  {ad_group.id} AS "adgroupId",
  {ad_group.name} AS "adgroupName",
  {metrics.cost_micros} AS "costMicros",
  {metrics.clicks} AS "clicks",
  {metrics.impressions} AS "impressions",
  {segments.date} AS "segmentDate",
  CASE {segments.device} WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN 'Mobile Phones' WHEN 3 THEN 'Tablets' WHEN 4 THEN 'Computers' WHEN 5 THEN '5' WHEN 6 THEN '6' WHEN 7 THEN '7' END AS "segmentDevice",
  {segments.keyword.info.text} AS "segmentsKeywordInfoText",
  {search_term_view.search_term} AS "searchTerm"
""",
    "google_conversion_type": """
SELECT DISTINCT
  {campaign.id} AS "campaignId",
  {campaign.name} AS "campaignName",
  {ad_group.id} AS "adgroupId",
  {ad_group.name} AS "adgroupName",
  {segments.conversion_action_name} AS "conversionActionName",
  {segments.date} AS "segmentDate",
  CASE {segments.device} WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN 'Mobile Phones' WHEN 3 THEN 'Tablets' WHEN 4 THEN 'Computers' WHEN 5 THEN '5' WHEN 6 THEN '6' WHEN 7 THEN '7' END AS "segmentDevice",
  {segments.keyword.info.text} AS "segmentsKeywordInfoText",
  {search_term_view.search_term} AS "searchTerm",
  {metrics.all_conversions} AS "metricsAllConversions"
WHERE ({segments.conversion_action_name}) IN ('purchase', 'signup')
""",
    "google_adgroup": """
SELECT
  {metrics.all_conversions_value} AS "metricAllConversionsValue",
  {metrics.all_conversions} AS "metricAllConversions",
  {metrics.cost_per_all_conversions} AS "metricsCostPerAllConversions",
  {metrics.cost_per_conversion} AS "metricsCostPerConversion",
  {metrics.conversions_value} AS "metricsConversionsValue",
  {metrics.clicks} AS "metricsClicks",
  {metrics.conversions} AS "metricsConversions",
  {metrics.cross_device_conversions} AS "metricsCrossDeviceConversions",
  {metrics.impressions} AS "metricsImpressions",
  {metrics.interactions} AS "metricsInteractions",
  {metrics.value_per_conversion} AS "metricsValuePerConversion",
  {metrics.video_views} AS "metricsVideoView",
  CAST(round_even(CAST({metrics.cost_micros} AS DOUBLE) * 0.000001, 0) AS BIGINT) AS "metricsCostMicors",
  {segments.ad_network_type} AS "segmentsAdNetworkType",
  {segments.date} AS "segmentsDate",
  {segments.device} AS "segmentsDevice",
  {campaign.id} AS "campaignID",
  {campaign.name} AS "campaignName",
  {ad_group.id} AS "adgroupID",
  {ad_group.name} AS "adgroupName",
  {ad_group.status} AS "adgroupStatus",
  {ad_group.type_} AS "adgroupType"
WHERE ({metrics.cost_micros}) > 0
""",
    "google_asset": """
SELECT
  {segments.date} AS "segmentsDate",
  {campaign.id} AS "campaignID",
  {campaign.name} AS "campaignName",
  {ad_group.id} AS "adgroupID",
  {ad_group.name} AS "adgroupName",
  {asset.id} AS "assetID",
  {asset.name} AS "assetName",
  CASE {asset.type_} WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN 'YouTube video' WHEN 3 THEN '3' WHEN 4 THEN '4' WHEN 5 THEN 'Text' WHEN 6 THEN '6' WHEN 7 THEN '7' WHEN 8 THEN '8' WHEN 9 THEN '9' WHEN 10 THEN '10' WHEN 11 THEN '11' WHEN 12 THEN '12' WHEN 13 THEN '13' WHEN 14 THEN '14' WHEN 15 THEN '15' WHEN 16 THEN '16' WHEN 17 THEN '17' WHEN 18 THEN '18' WHEN 19 THEN '19' WHEN 20 THEN '20' WHEN 21 THEN '21' WHEN 22 THEN '22' WHEN 23 THEN '23' WHEN 24 THEN '24' WHEN 25 THEN '25' WHEN 26 THEN '26' END AS "assetType",
  CASE {ad_group_ad_asset_view.field_type} WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN 'Headline' WHEN 3 THEN 'Description' WHEN 4 THEN '4' WHEN 5 THEN '5' WHEN 6 THEN '6' WHEN 7 THEN 'YouTube video' WHEN 8 THEN '8' WHEN 9 THEN '9' WHEN 10 THEN '10' WHEN 11 THEN '11' WHEN 12 THEN '12' WHEN 13 THEN '13' WHEN 14 THEN '14' WHEN 15 THEN '15' WHEN 16 THEN '16' WHEN 17 THEN '17' WHEN 18 THEN '18' WHEN 19 THEN '19' WHEN 20 THEN '20' WHEN 21 THEN '21' WHEN 22 THEN '22' WHEN 23 THEN '23' WHEN 24 THEN '24' WHEN 25 THEN '25' WHEN 26 THEN '26' END AS "assetFieldType",
  {asset.text_asset.text} AS "assetText",
  {asset.image_asset.full_size.url} AS "assetImageFullSizeURL",
  {asset.youtube_video_asset.youtube_video_title} AS "assetYoutubeTitle",
  CASE WHEN {asset.type_} = 2 THEN concat('https://www.youtube.com/watch?v=', {asset.youtube_video_asset.youtube_video_id}) ELSE '' END AS "assetYoutubeVideoURL",
  {asset.youtube_video_asset.youtube_video_id} AS "assetYoutubeVideoID",
  CASE {ad_group_ad_asset_view.performance_label} WHEN 0 THEN '0' WHEN 1 THEN '-' WHEN 2 THEN '2' WHEN 3 THEN 'Learning' WHEN 4 THEN 'Low' WHEN 5 THEN 'Good' WHEN 6 THEN 'Best' END AS "assetPerformanceLevel",
  {metrics.all_conversions_value} AS "metricsAllConversionValue",
  {metrics.conversions} AS "metricsConversions",
  {metrics.clicks} AS "metricsClicks",
  {metrics.ctr} AS "metricsCTR",
  {metrics.impressions} AS "metricsImpressions",
  CAST(round_even(CAST({metrics.cost_micros} AS DOUBLE) * 0.000001, 0) AS BIGINT) AS "metricsCostMicors",
  {segments.ad_network_type} AS "segmentsAdNetworkType"
WHERE ({ad_group_ad_asset_view.enabled}) IN (true)
""",
    "google_install_adgroup": """
SELECT
  {segments.date} AS "segmentsDate",
  {campaign.id} AS "campaignID",
  {campaign.name} AS "campaignName",
  {ad_group.id} AS "adgroupID",
  {ad_group.name} AS "adgroupName",
  {ad_group.status} AS "adgroupStatus",
  {campaign.advertising_channel_sub_type} AS "campaignAdvertisingChannelSubType",
  {metrics.cost_micros} AS "metricsCostMicros",
  {metrics.impressions} AS "metricsImpressions",
  {segments.ad_network_type} AS "segmentsAdNetworkType",
  CASE {segments.ad_network_type} WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN 'Search' WHEN 3 THEN 'Search' WHEN 4 THEN 'Display' WHEN 5 THEN 'Search' WHEN 6 THEN 'Youtube' WHEN 7 THEN '7' END AS "segmentsAdNetworkTypeName"
""",
    "google_installs": """
SELECT
  {metrics.biddable_app_install_conversions} AS "metricsInstallConversions",
  {segments.ad_network_type} AS "segmentsAdNetworkType",
  {segments.date} AS "segmentsDate",
  {campaign.id} AS "campaignID",
  {ad_group.id} AS "adgroupID"
WHERE ({ad_group_ad_asset_view.enabled}) IN (true)
""",
    "google_ad_asset": """
SELECT
  {campaign.id} AS "campaignId",
  {campaign.name} AS "campaignName",
  {ad_group.id} AS "adgroupId",
  {ad_group.name} AS "adgroupName",
  {ad_group_ad.ad.id} AS "adId",
  {ad_group_ad.ad.name} AS "adName",
  {asset.id} AS "assetId",
  {asset.name} AS "assetName",
  {metrics.cost_micros} AS "costMicros",
  {metrics.clicks} AS "clicks",
  {metrics.impressions} AS "impressions",
  {metrics.conversions} AS "conversions",
  {segments.date} AS "segmentDate"
""",
    "google_marked_ad": """
SELECT
  {campaign.id} AS "campaignId",
  {campaign.name} AS "campaignName",
  {ad_group.id} AS "adgroupId",
  {ad_group.name} AS "adgroupName",
  {ad_group_ad.ad.id} AS "adId",
  {ad_group_ad.ad.name} AS "adName",
  CASE WHEN strpos({ad_group_ad.ad.final_urls}, 'mkt_') = 0 THEN NULL ELSE string_split({ad_group_ad.ad.final_urls}, 'mkt_')[2] END AS "assetName",
  {metrics.cost_micros} AS "costMicros",
  {metrics.clicks} AS "clicks",
  {metrics.impressions} AS "impressions",
  {metrics.conversions} AS "conversions",
  {segments.date} AS "segmentDate"
""",
    "google_keyword_view": """
SELECT
  {campaign.id} AS "campaignId",
  {campaign.name} AS "campaignName",
  {ad_group.id} AS "adgroupId",
  {ad_group.name} AS "adgroupName",
  {ad_group_criterion.criterion_id} AS "keywordId",
  {ad_group_criterion.keyword.text} AS "keywordName",
  {ad_group_criterion.keyword.match_type} AS "keywordMatchType",
  {metrics.cost_micros} AS "costMicros",
  {metrics.clicks} AS "clicks",
  {metrics.impressions} AS "impressions",
  {metrics.conversions} AS "conversions",
  {metrics.ctr} AS "ctr",
  {segments.date} AS "segmentDate"
""",
    "google_campaign": """
SELECT
  {segments.date} AS "segmentsDate",
  {campaign.id} AS "campaignID",
  {campaign.name} AS "campaignName",
  {campaign.advertising_channel_type} AS "campaignAdvertisingChannelType",
  {campaign.optimization_score} AS "campaignOptimizationScore",
  {metrics.average_cpv} AS "metricsAverageCPV",
  {metrics.average_cpm} AS "metricsAverageCPM",
  {metrics.average_cpe} AS "metricsAverageCPE",
  {metrics.average_cpc} AS "metricsAverageCPC",
  {metrics.average_cost} AS "metricsAverageCost",
  {metrics.clicks} AS "metricsClicks",
  {metrics.conversions} AS "metricsConversions",
  {metrics.cost_per_conversion} AS "metricsCostPerConversion",
  {metrics.interactions} AS "metricsInteractions",
  {metrics.interaction_rate} AS "metricsInteractionRate",
  {metrics.impressions} AS "metricsImpressions",
  {metrics.ctr} AS "metricsCTR",
  {metrics.cost_micros} AS "metricsCostMicors",
  {metrics.active_view_ctr} AS "metricsActiveViewCTR",
  {metrics.active_view_cpm} AS "metricsActiveViewCPM",
  {metrics.active_view_impressions} AS "metricsActiveViewImpressions",
  {metrics.conversions_from_interactions_rate} AS "metricsConversionFromInteractionsRate"
""",
    "google_ad_viewability": """
SELECT
  {campaign.id} AS "campaignId",
  {campaign.name} AS "campaignName",
  {ad_group.id} AS "adgroupId",
  {ad_group.name} AS "adgroupName",
  {metrics.average_cost} AS "averageCost",
  {metrics.clicks} AS "clicks",
  {metrics.conversions} AS "conversions",
  {metrics.impressions} AS "impressions",
  {metrics.ctr} AS "ctr",
  {metrics.active_view_viewability} AS "activeViewViewability",
  {ad_group_ad.ad.id} AS "adId",
  {ad_group_ad.ad.resource_name} AS "adName",
  {segments.date} AS "segmentDate"
""",
    "google_responsive": """
SELECT
  {campaign.id} AS "campaignId",
  {campaign.name} AS "campaignName",
  {ad_group.id} AS "adgroupId",
  {ad_group.name} AS "adgroupName",
  {ad_group_ad.ad.id} AS "adId",
  {ad_group_ad.ad.responsive_display_ad.long_headline.text} AS "adName",
  {ad_group_ad.ad.responsive_display_ad.descriptions} AS "adDescriptions",
  {metrics.cost_micros} AS "costMicros",
  {metrics.clicks} AS "clicks",
  {metrics.impressions} AS "impressions",
  {metrics.conversions} AS "conversions",
  {segments.date} AS "segmentDate",
  {segments.device} AS "segmentDevice"
""",
    "google_impression_share": """
SELECT
  {campaign.id} AS "campaignId",
  {campaign.name} AS "campaignName",
  {ad_group.id} AS "adgroupId",
  {ad_group.name} AS "adgroupName",
  {ad_group_criterion.keyword.text} AS "keyword",
  {metrics.cost_micros} AS "costMicros",
  {metrics.clicks} AS "clicks",
  {metrics.impressions} AS "impressions",
  {metrics.search_impression_share} AS "searchImpressionShare",
  {segments.date} AS "segmentDate"
""",
    "google_asset_history": """
SELECT
  {asset.id} AS "assetID",
  {asset.name} AS "assetName",
  {segments.ad_network_type} AS "segmentsAdNetworkType",
  {ad_group.name} AS "adgroupName",
  {metrics.conversions} AS "metricConversions",
  {metrics.conversions_value} AS "metricConversionsValue",
  {metrics.all_conversions_value} AS "metricsAllConversionValue",
  {metrics.impressions} AS "metricsImpressions",
  {metrics.clicks} AS "metricsClicks",
  {metrics.ctr} AS "metricsCTR",
  {segments.date} AS "segmentsDate",
  {campaign.id} AS "campaignID",
  CASE {asset.type_} WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN 'YouTube video' WHEN 3 THEN '3' WHEN 4 THEN '4' WHEN 5 THEN 'Text' WHEN 6 THEN '6' WHEN 7 THEN '7' WHEN 8 THEN '8' WHEN 9 THEN '9' WHEN 10 THEN '10' WHEN 11 THEN '11' WHEN 12 THEN '12' WHEN 13 THEN '13' WHEN 14 THEN '14' WHEN 15 THEN '15' WHEN 16 THEN '16' WHEN 17 THEN '17' WHEN 18 THEN '18' WHEN 19 THEN '19' WHEN 20 THEN '20' WHEN 21 THEN '21' WHEN 22 THEN '22' WHEN 23 THEN '23' WHEN 24 THEN '24' WHEN 25 THEN '25' WHEN 26 THEN '26' END AS "assetType"
""",
    "google_asset_history_installs": """
SELECT
  {asset.id} AS "assetID",
  {asset.name} AS "assetName",
  {segments.ad_network_type} AS "segmentsAdNetworkType",
  {ad_group.name} AS "adgroupName",
  {metrics.conversions} AS "metricConversions",
  {metrics.conversions_value} AS "metricConversionsValue",
  {metrics.all_conversions_value} AS "metricsAllConversionValue",
  {metrics.impressions} AS "metricsImpressions",
  {metrics.clicks} AS "metricsClicks",
  {metrics.ctr} AS "metricsCTR",
  {segments.date} AS "segmentsDate",
  {campaign.id} AS "campaignID",
  {asset.type_} AS "assetType",
  {metrics.biddable_app_install_conversions} AS "metricsBiddableAppInstallConversion",
  {metrics.biddable_app_post_install_conversions} AS "metricsBiddableAppPostInstallConversion"
""",
    "facebook_ad": """
SELECT
  {ad_id} AS "adId",
  {ad_name} AS "adName",
  {adset_id} AS "adsetId",
  {adset_name} AS "adsetName",
  {campaign_id} AS "campaignId",
  {campaign_name} AS "campaignName",
  {date_start} AS "dateStart",
  {date_stop} AS "dateStop",
  CASE WHEN ({impressions}) IS NULL OR ({impressions}) = '' THEN '0' ELSE {impressions} END AS "impressions",
  CASE WHEN ({frequency}) IS NULL OR ({frequency}) = '' THEN '0' ELSE {frequency} END AS "frequency",
  CASE WHEN ({reach}) IS NULL OR ({reach}) = '' THEN '0' ELSE {reach} END AS "reach",
  CASE WHEN ({spend}) IS NULL OR ({spend}) = '' THEN '0' ELSE {spend} END AS "spend",
  CASE WHEN ({video_p25_watched_actions}) IS NULL OR ({video_p25_watched_actions}) = '' THEN '0' ELSE {video_p25_watched_actions} END AS "videoP25WatchedActions",
  CASE WHEN ({video_p50_watched_actions}) IS NULL OR ({video_p50_watched_actions}) = '' THEN '0' ELSE {video_p50_watched_actions} END AS "videoP50WatchedActions",
  CASE WHEN ({video_p75_watched_actions}) IS NULL OR ({video_p75_watched_actions}) = '' THEN '0' ELSE {video_p75_watched_actions} END AS "videoP75WatchedActions",
  CASE WHEN ({video_p100_watched_actions}) IS NULL OR ({video_p100_watched_actions}) = '' THEN '0' ELSE {video_p100_watched_actions} END AS "videoP100WatchedActions",
  CASE WHEN ({video_play_actions}) IS NULL OR ({video_play_actions}) = '' THEN '0' ELSE {video_play_actions} END AS "videoPlayActions",
  CASE WHEN ({link_click}) IS NULL OR ({link_click}) = '' THEN '0' ELSE {link_click} END AS "linkClick"
""",
    "facebook_account": """
SELECT
  {account_id} AS "accountId",
  {date_start} AS "dateStart",
  {date_stop} AS "dateStop",
  CASE WHEN ({impressions}) IS NULL OR ({impressions}) = '' THEN '0' ELSE {impressions} END AS "impressions",
  CASE WHEN ({reach}) IS NULL OR ({reach}) = '' THEN '0' ELSE {reach} END AS "reach",
  CASE WHEN ({spend}) IS NULL OR ({spend}) = '' THEN '0' ELSE {spend} END AS "spend",
  CASE WHEN ({video_p100_watched_actions}) IS NULL OR ({video_p100_watched_actions}) = '' THEN '0' ELSE {video_p100_watched_actions} END AS "videoP100WatchedActions",
  CASE WHEN ({video_play_actions}) IS NULL OR ({video_play_actions}) = '' THEN '0' ELSE {video_play_actions} END AS "videoPlayActions",
  CAST(NULL AS VARCHAR) AS "mobileAppInstall",
  CAST(NULL AS VARCHAR) AS "omniAppInstall",
  CAST(NULL AS VARCHAR) AS "postEngagement",
  CAST(NULL AS VARCHAR) AS "videoView",
  CAST(NULL AS VARCHAR) AS "landingPageView",
  {app_install} AS "appInstall",
  CAST(NULL AS VARCHAR) AS "omniActivateApp",
  {link_click} AS "linkClick",
  CAST(NULL AS VARCHAR) AS "uniqueMobileAppInstall",
  CAST(NULL AS VARCHAR) AS "uniqueOmniAppInstall",
  CAST(NULL AS VARCHAR) AS "uniquePostEngagement",
  CAST(NULL AS VARCHAR) AS "uniqueVideoView",
  CAST(NULL AS VARCHAR) AS "uniqueLandingPageView",
  {app_install} AS "uniqueAppInstall",
  CAST(NULL AS VARCHAR) AS "uniqueOmniActivateApp",
  {link_click} AS "uniqueLinkClick"
""",
}
